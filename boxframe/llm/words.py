"""Words of a text and hashes of their runs, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Distinct words whose hashes a worker keeps.
MEMO = 120_000
_BASE = 0x9E3779B97F4A7C15 | 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


_memo = _Hashes()


#: Rows that are worked on at a time; bounds what a worker holds besides the batch it was sent.
SLICE = 512


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def split_words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and U+0009 to U+000D, as UTF-8."""
    return (text or "").encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_memo) > MEMO:
        _memo.clear()
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by polynomials of doubling length."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    found, found_size, part, part_size = None, 0, hashes, 1
    with np.errstate(over="ignore"):
        while True:
            if size & part_size:
                if found is None:
                    found, found_size = part, part_size
                else:
                    count = len(hashes) - found_size - part_size + 1
                    power = np.uint64(pow(_BASE, part_size, 1 << 64))
                    found = found[:count] * power + part[found_size : found_size + count]
                    found_size += part_size
            if part_size * 2 > size:
                break
            power = np.uint64(pow(_BASE, part_size, 1 << 64))
            part = part[:-part_size] * power + part[part_size:]
            part_size *= 2
        return mixed(found)
