"""Encoding to subword pieces and back: unigram Viterbi over a double-array trie.

Pieces come from a SentencePiece model file. A file of unigram type stores log scores; one of merge type
stores minus the rank of a piece, from which a log score is made by Zipf's law: ``-log(rank + 1)`` less
the logarithm of the sum over all ranks. Nothing is trained.

The best segmentation of a word is independent of its neighbours as no piece holds a space marker after
another character, so each distinct word of a batch is segmented once, and words of one length are
segmented together, column by column, with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: A character without a piece of its own scores this much less than the worst piece, as in the library.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose IDs a worker keeps.
MEMO = 150_000
#: Words up to this many bytes are segmented in groups of one length.
GROUPED = 48
#: Rows that are worked on at a time.
SLICE = 512


@dataclass
class Trie:
    """Double array: the child of node ``s`` by byte ``c`` is ``t = base[s] + c + 1`` where ``check[t] == s``."""

    base: np.ndarray
    check: np.ndarray
    #: Index of the piece that ends at a node, or -1.
    piece: np.ndarray

    @classmethod
    def of(cls, words: dict[bytes, int]) -> Trie:
        children: dict[bytes, list[int]] = {b"": []}
        for word in sorted(words):
            for i in range(len(word)):
                if word[: i + 1] not in children:
                    children[word[: i + 1]] = []
                    children[word[:i]].append(word[i])
        size = 2 * len(children) + 1024
        base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0], low, high, todo = True, 257, 257, [(b"", 0)]
        while todo:
            prefix, node = todo.pop()
            piece[node] = words.get(prefix, -1)
            codes = children[prefix]
            if not codes:
                continue
            steps = np.array(codes) + 1
            # The first child takes a free place; the others must fit after it.
            # Nodes with many children go behind all others, and nodes with few fill the gaps.
            at, width = low if len(codes) <= 3 else high, 512
            while True:
                while at + width + 514 >= len(used):
                    more = len(used)
                    base, check, piece = (np.concatenate([x, np.full(more, v, np.int32)]) for x, v in ((base, 0), (check, -1), (piece, -1)))
                    used = np.concatenate([used, np.zeros(more, bool)])
                free = np.flatnonzero(~used[at : at + width])
                if at <= low and len(free) < width // 8:
                    low = at + width
                if at <= high and len(free) < width // 2:
                    high = at + width
                starts = at + free - steps[0]
                for step in steps[1:]:
                    starts = starts[~used[starts + step]]
                if len(starts):
                    start = int(starts[0])
                    break
                at += width
            base[node] = start
            used[start + steps], check[start + steps] = True, node
            high = max(high, start + int(steps[0]))
            todo += [(prefix + bytes([c]), start + c + 1) for c in codes]
        end = int(np.flatnonzero(used).max()) + 258
        return cls(base[:end], check[:end], piece[:end])


@dataclass
class Pieces:
    """Vocabulary, its scores and its trie. ``plain`` maps a piece's place among the segmenting ones to its ID."""

    trie: Trie
    plain: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    #: Bytes that each ID decodes to, all in one buffer.
    spelled: np.ndarray
    starts: np.ndarray
    unknown: int
    worst: float
    memo: dict = field(default_factory=dict)
    old: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        stored = np.array([model.get_score(i) for i in ids], np.float64)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        in_bytes = [model.is_byte(i) for i in ids]
        plain = np.array([i for i in ids if not special[i] and not in_bytes[i]], np.int32)
        scores = stored[plain]
        if np.array_equal(scores, np.round(scores)):
            rank = -scores
            scores = -np.log(rank + 1) - np.log(np.sum(1 / (rank + 1)))
        byte_ids = np.full(256, -1, np.int32)
        for i in ids:
            if in_bytes[i]:
                byte_ids[int(names[i][3:5], 16)] = i
        if any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
            raise ValueError("pieces that go on after a space are not supported")
        spelled = [
            b"" if special[i] else bytes([int(names[i][3:5], 16)]) if in_bytes[i] else names[i].replace(MARK, " ").encode()
            for i in ids
        ]
        trie = Trie.of({names[i].encode(): k for k, i in enumerate(plain)})
        return cls(
            trie,
            plain,
            scores.astype(np.float32),
            byte_ids,
            np.frombuffer(b"".join(spelled), np.uint8),
            np.concatenate([[0], np.cumsum([len(x) for x in spelled])]),
            model.unk_id(),
            float(scores.min()) - UNKNOWN_PENALTY,
        )

    def segment(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """IDs of words of one length, the rows of a byte matrix, end to end, and where each word's end."""
        n, length = words.shape
        best = np.full((length + 1, n), -np.inf, np.float32)
        best[0] = 0
        # Where the last piece of the best path to a place starts, and which piece it is (-1: a character without one).
        came, taken = np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -2, np.int32)
        columns = np.ascontiguousarray(words.T)
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        for s in range(length):
            rows = np.flatnonzero((columns[s] & 0xC0) != 0x80)
            if not len(rows):
                continue
            width = _width(columns[s][rows])
            sure = np.zeros(n, bool)
            node, alive = np.zeros(len(rows), np.int32), rows
            for e in range(s, length):
                to = base[node] + columns[e][alive] + 1
                there = check[to] == node
                node, alive = to[there], alive[there]
                if not len(alive):
                    break
                ends = piece[node]
                got = ends >= 0
                if got.any():
                    at, which = alive[got], ends[got]
                    score = best[s][at] + self.scores[which]
                    better = score > best[e + 1][at]
                    at, which, score = at[better], which[better], score[better]
                    best[e + 1][at], came[e + 1][at], taken[e + 1][at] = score, s, which
                    whole = alive[got]
                    sure[whole[_width(columns[s][whole]) == e + 1 - s]] = True
            lost = ~sure[rows]
            for w in np.unique(width[lost]):
                at = rows[lost & (width == w)]
                e = min(s + int(w), length)
                score = best[s][at] + np.float32(self.worst)
                at, score = at[score > best[e][at]], score[score > best[e][at]]
                best[e][at], came[e][at], taken[e][at] = score, s, -1
        return self._walk_back(columns, came, taken)

    def segment_long(self, raw: bytes) -> np.ndarray:
        """IDs of one word of any length: the trie is walked from all its characters at once, a byte a step, and
        the best path is then found over the pieces met. Paths of equal score: the last piece is the longest."""
        text = np.frombuffer(raw, np.uint8)
        starts = np.flatnonzero((text & 0xC0) != 0x80)
        width = np.minimum(_width(text[starts]), len(text) - starts)
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        node, alive, place = np.zeros(len(starts), np.int32), starts, np.arange(len(starts))
        sure, found, depth = np.zeros(len(starts), bool), [], 0
        while len(alive):
            to = base[node] + text[alive + depth] + 1
            there = check[to] == node
            node, alive, place = to[there], alive[there], place[there]
            depth += 1
            got = piece[node] >= 0
            found.append((alive[got], alive[got] + depth, piece[node[got]]))
            sure[place[got & (width[place] == depth)]] = True
            more = alive + depth < len(text)
            node, alive, place = node[more], alive[more], place[more]
        lone = np.flatnonzero(~sure)
        found.append((starts[lone], starts[lone] + width[lone], np.full(len(lone), -1)))
        start, end, which = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((start, end))
        start, end, which = start[order], end[order], which[order]
        score = np.where(which >= 0, self.scores[np.maximum(which, 0)].astype(float), self.worst)
        best, last = [-np.inf] * (len(text) + 1), [-1] * (len(text) + 1)
        best[0] = 0.0
        for i, (a, b, s) in enumerate(zip(start.tolist(), end.tolist(), score.tolist(), strict=True)):
            s += best[a]
            if s > best[b]:
                best[b], last[b] = s, i
        path, at = [], len(text)
        while at:
            path.append(last[at])
            at = int(start[last[at]])
        spelled = self.byte_ids.min() >= 0
        out = []
        for i in reversed(path):
            if which[i] >= 0:
                out.append(self.plain[which[i]])
            elif spelled:
                out += self.byte_ids[text[start[i] : end[i]]].tolist()
            else:
                out.append(self.unknown)
        return np.array(out, np.int32)

    def _walk_back(self, columns: np.ndarray, came: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length, n = columns.shape
        steps, at, live = [], np.full(n, length), np.arange(n)
        while len(live):
            place = at[live]
            which, start = taken[place, live], came[place, live]
            ids = np.where(which >= 0, self.plain[np.maximum(which, 0)], self.unknown)
            if (which == -1).any() and self.byte_ids.min() >= 0:
                # Spelled byte by byte, from the last one.
                raw = which == -1
                for back in range(1, 5):
                    some = raw & (place - back >= start)
                    if some.any():
                        steps.append((live[some], self.byte_ids[columns[place[some] - back, live[some]]]))
                keep = ~raw
                steps.append((live[keep], ids[keep]))
            else:
                steps.append((live, ids))
            at[live] = start
            live = live[start > 0]
        owner = np.concatenate([o for o, _ in steps])[::-1]
        ids = np.concatenate([i for _, i in steps])[::-1]
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.cumsum(np.bincount(owner, minlength=n))

    def _learn(self, words: set[str]) -> None:
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode()
            by_length.setdefault(len(raw), []).append((word, raw))
        for length, some in by_length.items():
            if length > GROUPED:
                self.memo.update((word, self.segment_long(raw).tobytes()) for word, raw in some)
                continue
            step = max(1, 400_000 // length)
            for i in range(0, len(some), step):
                part = some[i : i + step]
                matrix = np.frombuffer(b"".join(r for _, r in part), np.uint8).reshape(len(part), length)
                ids, ends = self.segment(matrix)
                raw, start = ids.tobytes(), 0
                for (word, _), end in zip(part, (4 * ends).tolist(), strict=True):
                    self.memo[word], start = raw[start:end], end

    def encode(self, texts: list[str]) -> list[bytes]:
        """IDs of whole texts, as bytes of 32-bit integers. Every text starts with a space marker."""
        if len(self.memo) > MEMO:
            # Words of the last generation stay within reach, so none that keeps coming is learnt again.
            self.memo, self.old = {}, self.memo
        cut = []
        for text in texts:
            if not text:
                cut.append([])
                continue
            words = [f"{MARK}{w}" for w in text.split(" ")]
            if MARK in words or MARK in text:
                words = re.findall(f"{MARK}+[^{MARK}]*", "".join(words))
            cut.append(words)
        new: set[str] = set()
        for words in cut:
            new.update(w for w in words if w not in self.memo)
        for w in [w for w in new if w in self.old]:
            self.memo[w] = self.old[w]
            new.discard(w)
        self._learn(new)
        out = [b"".join([self.memo[w] for w in words]) for words in cut]
        # Long ones seldom come again and would make the memo large.
        for w in [w for w in new if len(w) > GROUPED]:
            del self.memo[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of IDs: pieces and bytes spelled out, markers as spaces, without the first one."""
        lengths = np.diff(self.starts)[ids]
        first = np.repeat(self.starts[ids] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(ids) else np.empty(0, int)
        raw = self.spelled[first + np.arange(len(first))].tobytes()
        return raw.decode("utf-8", "replace")[1 if raw[:1] == b" " else 0 :]


def _width(lead: np.ndarray) -> np.ndarray:
    return np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))


@lru_cache(maxsize=2)
def _loaded(path: str) -> Pieces:
    return Pieces.load(path)


def encode_pieces(docs: DataFrame, model: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """Add ``ids``, the piece IDs of the whole text; a column of that name is replaced.

    Characters without a piece become byte pieces, so decoding gives the text back. A null or empty text
    gives an empty array. Of paths with equal scores the one whose last piece is longer counts. A space marker (U+2581) in a text can't be told from a space, as in the library.
    No shuffle; each row is worked on alone, so repeated rows and an empty table need no care.
    """
    return _with_column(docs, text, ids, T.ArrayType(T.IntegerType()), model, _encode_column)


def decode_pieces(encoded: DataFrame, model: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, what the IDs spell; null IDs give null. A column of that name is replaced."""
    return _with_column(encoded, ids, text, T.StringType(), model, _decode_column)


def _encode_column(pieces: Pieces, column: pa.Array) -> pa.Array:
    blobs = pieces.encode([x or "" for x in column.to_pylist()])
    offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), np.int32)))


def _decode_column(pieces: Pieces, column: pa.Array) -> pa.Array:
    cuts = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out = [pieces.decode(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.array(out, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))


def _with_column(df: DataFrame, source: str, target: str, kind: T.DataType, model: str, convert) -> DataFrame:
    """All columns travel in a struct, so no name in ``df`` can clash with the two used here."""
    kept = [c for c in df.columns if c != target]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{source}`").alias("source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model)
        for batch in batches:
            # Small slices keep few words of long texts in memory at a time.
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), convert(pieces, part.column(1))], names=["row", "target"])

    shape = T.StructType([packed.schema["row"], T.StructField("target", kind)])
    return packed.mapInArrow(run, shape).select("row.*", F.col("target").alias(target))

