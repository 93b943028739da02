"""Token IDs in flat binary files.

One partition of documents, in ascending ID order, gives three files: token IDs as flat little-endian
unsigned integers (16 bits where the vocabulary allows, else 32), document offsets as 64-bit integers, one
more than there are documents, and document IDs as pairs of 64-bit integers (whether it is set, the ID).
A manifest table lists the files, with each partition's base: the tokens of all partitions before it, a
prefix sum. Readers map the files into memory where the folder is on a mounted file system.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import prefix_sums
from boxframe.operators.checkpoints import checkpoint_folder, cut_lineage

#: Distinct words whose IDs a worker keeps.
MEMO = 1_000_000
#: Bytes of text that are encoded at once; a longer text is a batch of its own.
CHUNK = 8 << 20
#: Most tasks that read files back; beyond that a task reads several.
READERS = 20_000
MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint"


class WordEncoder:
    """IDs of whole texts from a tokenizer file, as an array of ``kind``.

    The tokenizer never joins a character that is no white space with a space after it, so a text is cut
    there and each distinct piece is encoded once. Texts with other white space beside a space are cut only
    at spaces between two other characters.

    Pieces are entries of a table: ``begins`` and ``sizes`` name a run of ``ids``. Texts become entry numbers by
    Arrow's split and dictionary, and their IDs are gathered for a whole batch at once.
    """

    #: Entries that every table starts with: no ID, and the end ID if there is one.
    NONE, END = 0, 1

    def __init__(self, path: str, kind: str, end_id: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.end_id = Tokenizer.from_file(path), kind, end_id
        spelled = self.tokenizer.decode_batch([[i] for i in range(self.tokenizer.get_vocab_size())], skip_special_tokens=False)
        self.after_space = np.array([x.startswith(" ") for x in spelled])
        self._forget()

    def _forget(self) -> None:
        # Words after a space, and words at the start of a text.
        self.tails: dict[str, int] = {}
        self.heads: dict[str, int] = {}
        self.ids, self.begins, self.sizes = np.empty(1 << 16, self.kind), np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.n_ids = self.n_entries = 0
        self._add(np.array([] if self.end_id is None else [self.end_id]), np.array([0, 0 if self.end_id is None else 1]))

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Append entries of these sizes, whose IDs follow each other in ``ids``; the number of the first."""
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while self.n_entries + len(sizes) > len(self.sizes):
            self.begins, self.sizes = np.resize(self.begins, 2 * len(self.begins)), np.resize(self.sizes, 2 * len(self.sizes))
        first, last = self.n_entries, self.n_entries + len(sizes)
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.sizes[first:last] = sizes
        self.begins[first:last] = self.n_ids + np.cumsum(sizes) - sizes
        self.n_ids, self.n_entries = self.n_ids + len(ids), last
        return first

    def _encode(self, texts: list[str]) -> int:
        """Append an entry for each text."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([np.array(x, np.int64) for x in found]) if found else np.empty(0, np.int64)
        return self._add(flat, np.array([len(x) for x in found], np.int64))

    def _learn(self, words: list[str]) -> int:
        """Encode many words as one text; a token that starts with a space starts the next word."""
        ids = np.array(self.tokenizer.encode_batch_fast(["".join([f" {w}" for w in words])], add_special_tokens=False)[0].ids)
        cuts = np.flatnonzero(self.after_space[ids]) if len(ids) else ids
        if len(cuts) != len(words) or cuts[0] != 0:
            return self._encode([f" {w}" for w in words])
        return self._add(ids, np.diff(np.append(cuts, len(ids))))

    def _entries(self, words: pa.Array, heads: bool) -> np.ndarray:
        """The entry of each word; -1 for words that can't be encoded by themselves."""
        coded = words.dictionary_encode()
        distinct, memo = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.heads if heads else self.tails
        new = [w for w in distinct if w not in memo]
        # A head may be empty or start with white space, as nothing comes before it.
        alone = [w for w in new if (heads or w and not w[0].isspace()) and not w[-1:].isspace()]
        memo.update(dict.fromkeys(new, -1))
        for i in range(0, len(alone), 1000):
            some = alone[i : i + 1000]
            first = self._encode(some) if heads else self._learn(some)
            memo.update(zip(some, range(first, first + len(some)), strict=True))
        return np.array([memo[w] for w in distinct], np.int64)[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All IDs of the texts, one after another and each with the end ID, and their number for each text."""
        if len(self.tails) + len(self.heads) > MEMO:
            self._forget()
        cut = pc.split_pattern(texts, " ")
        words, bounds = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        rows, starts, counts = np.arange(len(texts)), bounds[:-1], np.diff(bounds)
        is_head = np.zeros(len(words), bool)
        is_head[starts] = True
        entries = np.empty(len(words), np.int64)
        entries[starts] = self._entries(words.take(pa.array(starts)), True)
        entries[~is_head] = self._entries(words.filter(pa.array(~is_head)), False)
        mark = self.n_ids, self.n_entries
        whole = np.flatnonzero(np.logical_or.reduceat(entries < 0, starts)) if len(rows) else rows
        if len(whole):
            # These texts are encoded as they are, in entries that are taken back below.
            first = self._encode(texts.take(pa.array(whole)).to_pylist())
            entries[np.isin(np.repeat(rows, counts), whole)] = self.NONE
            entries[starts[whole]] = first + np.arange(len(whole))
        entries = np.insert(entries, bounds[1:], self.END)
        sizes = self.sizes[entries]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begins[entries] - ends + sizes, sizes) + np.arange(sizes.sum())]
        totals = ends[bounds[1:] + rows]
        self.n_ids, self.n_entries = mark
        return ids, np.diff(totals, prepend=0)


def largest_id(path: str) -> int:
    """The largest ID of a tokenizer file, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


@lru_cache(maxsize=2)
def _encoder(path: str, kind: str, end_id: int | None) -> WordEncoder:
    return WordEncoder(path, kind, end_id)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _write(store: fs.FileSystem, path: str, chunks: list[bytes]) -> None:
    with store.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)


def _mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """The file as an array, without reading it where it can be mapped."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with store.open_input_file(path) as got:
        return np.frombuffer(got.read(), kind)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    wide: bool | None = None,
) -> DataFrame:
    """Encode all texts, write the files and return the manifest with its bases.

    A null text counts as empty. Rows with equal IDs follow each other in no fixed order; null IDs come
    first and read back as null. Other columns are not read. An empty table gives an empty manifest.

    IDs take 16 bits if the largest of the vocabulary and ``end_id`` fit, else 32, or always 32 with ``wide``.
    ``folder`` must be seen by all machines; a new one under the checkpoint folder is the default. Each
    attempt of a task writes files of its own name and only the manifest makes them count.
    """
    if wide is None:
        wide = max(largest_id(tokenizer), end_id or 0) > 0xFFFF
    folder = folder or f"{checkpoint_folder(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    kind = "<u4" if wide else "<u2"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, kind, end_id)
        store, root = _opened(folder)
        store.create_dir(root, recursive=True)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        path = f"{root}/{part:06d}-{name}"
        sizes, docs_seen = [np.empty(0, "<i8")], []
        with store.open_output_stream(f"{path}.bin") as out:
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                # Whole texts, about CHUNK bytes at a time.
                place = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // CHUNK
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(texts)]])
                for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    found, counts = encoder.batch(texts[i:j])
                    out.write(np.ascontiguousarray(found))
                    sizes.append(counts)
                docs_seen.append(np.stack([ids.is_valid().to_numpy(False).astype("<i8"), ids.fill_null(0).to_numpy(False).astype("<i8")], 1))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype="<i8")]).astype("<i8")
        _write(store, f"{path}.off", [offsets.tobytes()])
        _write(store, f"{path}.doc", [x.tobytes() for x in docs_seen])
        if len(offsets) > 1:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/{part:06d}-{name}"]), pa.array([len(offsets) - 1], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
                names=["part", "path", "n_docs", "n_tokens"],
            )

    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        # Spreads the rows of one ID over several partitions.
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
    )
    ranged = rows.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id").select("doc_id", "text")
    manifest = cut_lineage(ranged.mapInArrow(write, MANIFEST))
    return prefix_sums(manifest, "part", "n_tokens").withColumn("wide", F.lit(wide))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Rows ``doc_id``, ``start`` (tokens of all documents before it), ``n_tokens``, ``tokens`` (the IDs as
    little-endian unsigned 32-bit integers) in the files that a manifest lists."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _opened(row["path"])
                tokens = _mapped(store, f"{path}.bin", "<u4" if row["wide"] else "<u2")
                offsets = _mapped(store, f"{path}.off", "<i8")
                ids = _mapped(store, f"{path}.doc", "<i8").reshape(-1, 2)
                for i in range(0, len(ids), 1024):
                    some, cuts = ids[i : i + 1024], offsets[i : i + 1025]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(some[:, 1]), mask=np.array(some[:, 0] == 0)),
                            pa.array(np.array(cuts[:-1]) + row["base"]),
                            pa.array(np.diff(cuts)),
                            pa.array([tokens[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "tokens"],
                    )

    # A number, as adaptive execution would fold the small manifest, and so all reading, into one task.
    files = manifest.select("path", "base", "wide").repartition(min(max(1, manifest.count()), READERS), "path")
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, tokens binary")


