"""Substring de-duplication by relative Lempel-Ziv parsing.

Reference blocks are cut by content: in every window of :data:`WINDOW` words the run of :data:`SEED` words
with the least hash is the window's seed, and the windows that share one seed occurrence form a block. Equal
windows lie in blocks of one seed, so the index of blocks is keyed by it. Documents are parsed in three steps.

1. Seeds that one document alone holds can't repeat anything; their blocks are not looked at again.
2. A block is factored against the first block of its seed (in the smallest document): the windows that
   both hold are factors. This is one comparison per block, whatever the number of copies.
3. What is left lies at factor boundaries. Those windows are looked up one by one among the boundary
   windows of all blocks of the seed; a window that the first block holds can't be among them.

Windows found in a smaller document are merged into duplicate spans. Block hashes are 64-bit and compared
only below an equal 64-bit seed.

Hot passages: step 2 is a join that Spark splits where one seed holds many blocks, and step 3 counts with
partial aggregates. No pairs of documents are formed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxframe.llm.common import Scratch
from boxframe.llm.words import run_hashes, sliced, split_words, word_hashes

WINDOW = 50
SEED = 10
#: Windows of one text that are worked on at a time; bounds memory for long texts.
STRETCH = 1 << 20
_PLACES = np.uint64((1 << 24) - 1)


def blocks(hashes: np.ndarray, window: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per stretch: seed hash of each block, its first window (and one end more), and all window hashes."""
    reach = window - seed + 1
    for begin in range(0, max(0, len(hashes) - window + 1), STRETCH):
        part = hashes[begin : begin + STRETCH + window - 1]
        seeds = run_hashes(part, seed)
        # The place in the low bits makes the leftmost of equal seeds the least.
        least = (seeds & ~_PLACES) | np.arange(len(seeds), dtype=np.uint64)
        size = 1
        while size * 2 <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < reach:
            least = np.minimum(least[: size - reach], least[reach - size :])
        place = (least & _PLACES).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
        yield seeds[place[first[:-1]]].view(np.int64), first + begin, run_hashes(part, window).view(np.int64)


def _seeds(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        ids, texts = batch.column(0), batch.column(1)
        owner, found = [], []
        for i, text in enumerate(texts):
            here = [s for s, _, _ in blocks(word_hashes(split_words(text.as_py())), window, seed)]
            if here:
                found.append(np.unique(np.concatenate(here)))
                owner.append(np.full(len(found[-1]), i))
        if found:
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.concatenate(owner))), pa.array(np.concatenate(found))], names=["id", "seed"])


def _blocks(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        ids, keys, texts, shared = batch.columns
        owner, seeds, firsts, counts, windows, heads = [], [], [], [], [], []
        for i in range(len(texts)):
            wanted = shared[i].values
            known = wanted.field("seed").to_numpy(zero_copy_only=False)
            leads = wanted.field("leads").to_numpy(zero_copy_only=False)
            order = np.argsort(known)
            known, leads, met = known[order], leads[order], set()
            for seed_of, first, hashes in blocks(word_hashes(split_words(texts[i].as_py())), window, seed):
                at = np.minimum(np.searchsorted(known, seed_of), len(known) - 1)
                for b in np.flatnonzero(known[at] == seed_of).tolist():
                    start, end = int(first[b]), int(first[b + 1])
                    value = int(seed_of[b])
                    owner.append(i)
                    seeds.append(value)
                    firsts.append(start)
                    counts.append(end - start)
                    windows.append(hashes[start - int(first[0]) : end - int(first[0])])
                    heads.append(bool(leads[at[b]]) and value not in met)
                    met.add(value)
        if owner:
            at = pa.array(owner)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), keys.take(at), pa.array(seeds, pa.int64()), pa.array(firsts, pa.int32()), pa.array(heads), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(windows)))],
                names=["id", "key", "seed", "first", "leads", "windows"],
            )


def repeated_windows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Rows ``id``, ``key``, ``found``: an array of (first window, bits of the windows from it on that start
    in a document with a smaller ID). ``docs`` has ``id``, ``key`` (the text's hash) and ``text``."""
    scratch = Scratch(docs.sparkSession)
    # What is counted by seed is written before it is joined on it: then Spark can split the rows of a hot
    # seed over several tasks, which it can't below an aggregate of the same stage.
    # Seeds and blocks, both made from whole texts, are written once and read by all that needs them.
    per_doc = scratch.table(docs.select("id", "text").mapInArrow(lambda b: _seeds(b, window, seed), "id bigint, seed bigint"), "keys")
    first = scratch.table(
        per_doc.groupBy("seed")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
        .filter("leader < last")
        .select(F.col("seed").alias("seed_of"), "leader"),
        "seeds",
    )
    shared = (
        per_doc.join(first, F.col("seed") == F.col("seed_of"))
        .groupBy(F.col("id").alias("id_of"))
        # One document's seeds; repeated rows of one ID add nothing.
        .agg(F.collect_set(F.struct("seed", (F.col("id") == F.col("leader")).alias("leads"), "leader")).alias("shared"))
    )
    held = docs.join(shared, F.col("id") == F.col("id_of")).select("id", "key", "text", F.expr("transform(shared, s -> struct(s.seed, s.leads))").alias("shared"))
    shape = "id bigint, key bigint, seed bigint, first int, leads boolean, windows array<bigint>"
    occurrences = scratch.table(held.mapInArrow(lambda b: _blocks(b, window, seed), shape), "occurrences")
    scratch.done(per_doc, first)
    lead = scratch.table(
        occurrences.filter("leads").groupBy(F.col("seed").alias("lead_seed")).agg(F.min(F.struct("id", "key", "first", "windows")).alias("lead")), "first-blocks"
    )
    compared = occurrences.join(lead, F.col("seed") == F.col("lead_seed")).select(
        "id", "key", "seed", "first", "windows", F.col("lead.id").alias("leader"), F.expr("transform(windows, w -> array_contains(lead.windows, w))").alias("in_lead")
    )
    parsed = scratch.table(
        compared.select(
            "id",
            "key",
            "seed",
            "first",
            F.expr("if(id > leader, aggregate(transform(in_lead, (x, i) -> if(x, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b), 0L)").alias("bits"),
            F.expr("filter(transform(windows, (w, i) -> if(in_lead[i], null, struct(w, i))), x -> x is not null)").alias("rest"),
        ),
        "parsed",
    )
    scratch.done(occurrences, lead)
    rest = parsed.select("id", "key", "seed", "first", F.explode("rest").alias("x")).select("id", "key", "seed", "first", "x.w", "x.i")
    other = scratch.table(
        rest.groupBy(F.col("seed").alias("seed_of"), F.col("w").alias("w_of")).agg(F.min("id").alias("least"), F.max("id").alias("last")).filter("least < last"), "boundaries"
    )
    late = rest.join(other, (F.col("seed") == F.col("seed_of")) & (F.col("w") == F.col("w_of"))).filter("id > least").select("id", "key", "first", F.expr("shiftleft(1L, i)").alias("bits"))
    found = (
        parsed.filter("bits <> 0")
        .select("id", "key", "first", "bits")
        .union(late)
        # Combined before they are gathered, so that repeated rows of one document count once.
        .groupBy("id", "key", "first")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy(F.col("id").alias("id_of"), F.col("key").alias("key_of"))
        .agg(F.collect_list(F.struct("first", "bits")).alias("found"))
    )
    found = Scratch(docs.sparkSession).table(found, "spans")
    scratch.drop()
    return found


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spans(n_words: int, found: list[dict], window: int) -> list[tuple[int, int]]:
    """Maximal spans of covered words, as (first, end), from the marked windows."""
    change = np.zeros(n_words + 1, np.int64)
    for x in found:
        starts = np.flatnonzero((x["bits"] >> np.arange(63)) & 1) + x["first"]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
    covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    edges = np.flatnonzero(np.diff(covered.astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def cut(text: str, gone: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each of them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for first, end in gone:
        kept.append(text[at : places[first]])
        at = places[end]
    return "".join([*kept, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        row, texts, found = batch.columns
        kept, n_words, n_removed, gone = [], [], [], []
        for text, marks in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            words = len(split_words(text))
            here = spans(words, marks, window) if marks else []
            kept.append(cut(text, here) if here else text)
            n_words.append(words)
            n_removed.append(sum(b - a for a, b in here))
            gone.append([{"first": a, "end": b} for a, b in here])
        yield pa.RecordBatch.from_arrays(
            [row, pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(gone, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))],
            names=["row", "kept_text", "n_words", "n_removed", "spans"],
        )


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``row`` (a struct of all columns but the text), ``kept_text``, ``n_words``, ``n_removed``, ``spans``.

    A word is removed where a window of ``window`` words covers it that also starts in a document with a
    smaller ID; windows are those of the input. White space around kept words stays as it was. Spans count
    words from 0, the end excluded.

    A null text stays null with 0 words; texts shorter than a window keep all. Rows with equal IDs are one
    document: they don't remove words from each other. A null ID counts as larger than any other. Repeated
    rows are cut alike. An empty table gives no rows. Columns stay inside ``row``, so names can't clash.
    """
    if not seed <= window <= 60:
        raise ValueError("a window holds its seed and at most 60 words")
    column = F.col(f"`{text}`")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*kept).alias("row"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64(column).alias("key"),
        column.alias("text"),
    )
    found = repeated_windows(base.select("id", "key", "text"), window, seed)
    marked = base.join(found, (F.col("id") == F.col("id_of")) & (F.col("key") == F.col("key_of")), "left").select("row", "text", "found")
    shape = T.StructType(
        [marked.schema["row"]]
        + T._parse_datatype_string("kept_text string, n_words bigint, n_removed bigint, spans array<struct<first: int, end: int>>").fields
    )
    return marked.mapInArrow(lambda b: _cut(b, window), shape)
