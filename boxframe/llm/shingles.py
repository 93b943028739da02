"""Sets of word shingles and the keys under which similar sets meet.

Keys follow prefix filtering with token combinations. All tokens have one global order: rare tokens before
frequent ones, each by hash. A set's prefix holds so many tokens that a set with a Jaccard similarity of at
least ``percent`` to it can't miss them all. A rare token is a key by itself. Frequent tokens fall into
classes and only two of one class together make a key, so a prefix is extended: of each class one token
doesn't count. Two similar sets then share a rare token or two frequent ones of a class within their
prefixes. The number of classes follows the set's size (a power of two), and a set whose partners may
belong to the next larger size has keys for both.

Which tokens count as frequent changes only how many candidates meet, never which pairs are found.
"""

from __future__ import annotations

import numpy as np

from boxframe.llm.words import mixed, run_hashes, split_words, word_hashes

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Tokens of a set for each class of frequent ones.
PER_CLASS = 8


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words, A-Z in lower case.

    Fewer words form one shingle; a null text or one without words gives an empty set.
    """
    words = split_words(text.encode().translate(_LOWER).decode() if text else text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(size, len(words))))


def least_overlap(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that any similar set holds."""
    return -(-percent * n // 100)


def set_keys(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Keys of one set. ``frequent`` flags its tokens. A set of one token is similar to its copies only."""
    n = len(tokens)
    if n < 2:
        return np.empty(0, np.uint64)
    need = n - least_overlap(n, percent) + 1
    rare = tokens[~frequent]
    rare = np.sort(mixed(rare))[:need]
    if len(rare) == need:
        return rare
    common = np.sort(mixed(tokens[frequent]))
    keys, level = [rare], n.bit_length() - 1
    levels = [level] if 100 * n // percent < 2 << level else [level, level + 1]
    for level in levels:
        classes = max(1, (1 << level) // PER_CLASS)
        owner = (common >> np.uint64(8)) % np.uint64(classes)
        order = np.argsort(owner, kind="stable")
        first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]]) if len(order) else np.empty(0, bool)
        counts = np.ones(len(common), np.int64)
        counts[order[first]] = 0
        reached = np.flatnonzero(np.cumsum(counts) >= need - len(rare))
        end = int(reached[0]) + 1 if len(reached) else len(common)
        part, part_owner = common[:end], owner[:end]
        order = np.argsort(part_owner, kind="stable")
        part, part_owner = part[order], part_owner[order]
        gap = 1
        while gap < end:
            same = part_owner[gap:] == part_owner[:-gap]
            if not same.any():
                break
            with np.errstate(over="ignore"):
                pair = part[:-gap][same] * np.uint64(0x9E3779B97F4A7C15) + part[gap:][same] + np.uint64(level)
            keys.append(mixed(pair))
            gap += 1
    return np.unique(np.concatenate(keys))
