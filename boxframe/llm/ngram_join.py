"""Join of documents whose sets of word shingles are similar (Jaccard), by token-combination prefixes.

Candidates share a key of their prefixes (see :mod:`boxframe.llm.shingles`); every candidate is verified.
Documents with equal sets form a class, and only class representatives are compared.

Groups of near copies may be huge, so their pairs are never listed. Components are found as follows.

1. In each group of representatives under one key, all are compared with one leader, the representative of
   the largest class. Links give first components.
2. Only pairs in different components are left. Let x not be linked with its leader l. If x and y share no
   token outside l, their overlap is at most that of either with l, which numbers alone can decide. Else
   they share a token outside l, and near copies share few of those: they are joined on (l, token).
   A y linked with l can be left out if the similarity of x and l is below 1 - 2 (1 - threshold), as
   Jaccard distances obey the triangle inequality. Pairs far from their leader are listed; as groups under
   frequent tokens are cut by combinations, there are few.

Before sets are moved, a bound on the overlap from counts of hashed tokens (profiles) drops most candidates.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch, components
from boxframe.llm.shingles import set_keys, shingle_set
from boxframe.llm.words import sliced

SHINGLE = 5
PERCENT = 80
#: Counters of the frequency sketch, and the parts it is merged in. Fixed size; raise it for larger corpora.
CELLS = 1 << 22
PARTS = 64
#: A token is frequent if its counter reaches this, and stands out from the mean counter.
FREQUENT = 64
_NULL_ID = (1 << 63) - 1


def _cells(tokens: np.ndarray, cells: int) -> np.ndarray:
    return (tokens >> np.uint64(20)).astype(np.int64) & (cells - 1)


def profile(tokens: np.ndarray) -> bytes:
    """Tokens counted in hash buckets, about two in each."""
    size = max(16, 1 << max(0, len(tokens).bit_length() - 2))
    return np.bincount((tokens >> np.uint64(44)).astype(np.int64) & (size - 1), minlength=size).astype("<u2").tobytes()


def overlap_bound(a: bytes, b: bytes) -> int:
    """At most so many tokens are in both sets."""
    x, y = np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<u2").astype(np.int64)
    while len(x) > len(y):
        x = x.reshape(2, -1).sum(0)
    while len(y) > len(x):
        y = y.reshape(2, -1).sum(0)
    return int(np.minimum(x, y).sum())


def _facts(batches: Iterator[pa.RecordBatch], shingle: int, cells: int) -> Iterator[pa.RecordBatch]:
    """A row per document, then the task's counters in parts (``n`` is -1)."""
    counts = np.zeros(cells, np.uint32)
    names = ["id", "n", "sig", "blob"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in sliced(batches):
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            tokens = shingle_set(text.as_py(), shingle)
            np.add.at(counts, _cells(tokens, cells), 1)
            rows.append((doc, len(tokens), xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63), profile(tokens)))
        if rows:
            yield out(rows)
    step = cells // PARTS
    parts = [(i, -1, 0, zlib.compress(counts[i * step : (i + 1) * step].astype("<i8").tobytes(), 1)) for i in range(PARTS)]
    yield out(parts)


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(blob), "<i8")
    if sums:
        bits = [np.packbits(x >= least).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(bits, pa.binary())], names=["part", "bits"])


def _keys(batches: Iterator[pa.RecordBatch], bits: bytes, shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    frequent = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    for batch in sliced(batches):
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            tokens = shingle_set(text.as_py(), shingle)
            found = set_keys(tokens, frequent[_cells(tokens, len(frequent))], percent)
            keys.append(found.view(np.int64))
            ids.append(np.full(len(found), doc, np.int64))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["key", "id"])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sets = [shingle_set(x.as_py(), shingle).astype("<u8").tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id_of", "tokens"])


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        most = [overlap_bound(x, y) for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(most, pa.int64())], names=["a", "b", "na", "nb", "most"])


def _overlaps(batches: Iterator[pa.RecordBatch], outside: bool) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = []
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = np.intersect1d(x, y, assume_unique=True)
            rest = np.setdiff1d(x, both, assume_unique=True).view("<i8").tolist() if outside else []
            rows.append((a, b, len(x), len(y), len(both), rest))
        if rows:
            kinds = (*[pa.int64()] * 5, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "na", "nb", "both", "rest"])


class SimilarityJoin:
    """The steps of the join over one table; ``drop`` removes the tables they left."""

    def __init__(self, docs: DataFrame, text: str, doc_id: str, shingle: int, percent: int, cells: int, frequent: int):
        self.spark, self.shingle, self.percent = docs.sparkSession, shingle, percent
        self.scratch = Scratch(self.spark)
        self.docs = docs.select(
            F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(f"`{text}`").alias("text")
        )
        facts = self.scratch.table(
            self.docs.mapInArrow(lambda b: _facts(b, shingle, cells), "id bigint, n bigint, sig bigint, blob binary"), "facts"
        )
        held = facts.filter("n > 0")
        # What is counted by a key is written before it is joined on it, so that Spark can split a hot key.
        classes = self.scratch.table(held.groupBy(F.col("sig").alias("sig_of"), F.col("n").alias("n_of")).agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "classes")
        #: Every document: ``id``, ``n``, ``rep`` (null for an empty set), ``weight``.
        self.members = self.scratch.table(
            facts.filter("n >= 0").join(classes, (F.col("sig") == F.col("sig_of")) & (F.col("n") == F.col("n_of")), "left").select("id", "n", "rep", "weight"),
            "members",
        )
        self.scratch.done(classes)
        self.profiles = held.select(F.col("id").alias("id_of"), F.col("n").alias("n_of"), F.col("blob").alias("profile"))
        self.bits = self._frequent(facts, cells, frequent)

    def _frequent(self, facts: DataFrame, cells: int, least: int) -> bytes:
        """Which counters are high, as bits: a fixed ``cells`` / 8 bytes."""
        total = self.members.agg(F.sum("n")).first()[0] or 0
        # Eight deviations above what tokens in no relation give a counter.
        mean = total / cells
        least = max(least, math.ceil(mean + 8 * math.sqrt(mean)))
        parts = facts.filter("n = -1").select(F.col("id").alias("part"), F.col("blob"))
        # One row per part comes back.
        merged = parts.repartition("part").mapInArrow(lambda b: _merge(b, least), "part bigint, bits binary").collect()
        by_part = {r.part: bytes(r.bits) for r in merged}
        return b"".join(by_part.get(i, bytes(cells // PARTS // 8)) for i in range(PARTS))

    def groups(self) -> DataFrame:
        """Representatives under each key that several documents have: ``key``, ``node``, ``n``, ``weight``."""
        bits, shingle, percent = self.bits, self.shingle, self.percent
        # Written, as both branches need the keys of all texts.
        keys = self.scratch.table(self.docs.mapInArrow(lambda b: _keys(b, bits, shingle, percent), "key bigint, id bigint"), "keys")
        several = self.scratch.table(keys.groupBy(F.col("key").alias("key_of")).agg(F.count("*").alias("held")).filter("held > 1").select("key_of"), "several")
        mine = self.members.filter("rep is not null").select(F.col("id").alias("id_of"), F.col("rep").alias("node"), "n", "weight").distinct()
        met = keys.join(several, F.col("key") == F.col("key_of")).join(mine, F.col("id") == F.col("id_of")).select("key", "node", "n", "weight").distinct()
        met = self.scratch.table(met, "groups")
        self.scratch.done(keys, several)
        return met

    def similar(self, overlap, na, nb):
        return (100 + self.percent) * overlap >= self.percent * (na + nb)

    def sizes_fit(self, na, nb):
        return 100 * F.least(na, nb) >= self.percent * F.greatest(na, nb)

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """``a``, ``b``, ``na``, ``nb``, ``most``: an upper bound of the overlap."""
        left = self.profiles.select(F.col("id_of").alias("a_of"), F.col("n_of").alias("na"), F.col("profile").alias("pa"))
        right = self.profiles.select(F.col("id_of").alias("b_of"), F.col("n_of").alias("nb"), F.col("profile").alias("pb"))
        joined = pairs.join(left, F.col("a") == F.col("a_of")).join(right, F.col("b") == F.col("b_of"))
        return joined.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_bounds, "a bigint, b bigint, na bigint, nb bigint, most bigint")

    def overlaps(self, pairs: DataFrame, outside: bool = False) -> DataFrame:
        """Exact overlaps: ``a``, ``b``, ``na``, ``nb``, ``both``, and with ``outside`` the tokens of a not in b (``rest``)."""
        shingle = self.shingle
        # Written, so that Spark knows whether the IDs are few enough to send to all.
        nodes = self.scratch.table(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
        texts = self.docs.join(nodes, F.col("id") == F.col("node"), "left_semi")
        sets = self.scratch.table(texts.mapInArrow(lambda b: _sets(b, shingle), "id_of bigint, tokens binary"), "sets")
        left = sets.select(F.col("id_of").alias("a_of"), F.col("tokens").alias("ta"))
        right = sets.select(F.col("id_of").alias("b_of"), F.col("tokens").alias("tb"))
        joined = pairs.join(left, F.col("a") == F.col("a_of")).join(right, F.col("b") == F.col("b_of"))
        shape = "a bigint, b bigint, na bigint, nb bigint, both bigint, rest array<bigint>"
        return joined.select("a", "b", "ta", "tb").mapInArrow(lambda b: _overlaps(b, outside), shape)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are similar: ``a``, ``b``, ``both``, ``na``, ``nb``."""
        hopeful = self.scratch.table(self.bounded(pairs).filter(self.similar(F.col("most"), F.col("na"), F.col("nb"))).select("a", "b").distinct(), "hopeful")
        return self.overlaps(hopeful).filter(self.similar(F.col("both"), F.col("na"), F.col("nb"))).drop("rest")

    def component_links(self) -> DataFrame:
        """Links between representatives that connect all that are connected, not all links."""
        groups = self.groups()
        lead = groups.groupBy(F.col("key").alias("key_of")).agg(F.max(F.struct("weight", -F.col("node"))).alias("top"), F.count("*").alias("held")).filter("held > 1")
        lead = self.scratch.table(lead.select("key_of", (-F.col("top.col2")).alias("leader")), "lead")
        placed = self.scratch.table(groups.join(lead, F.col("key") == F.col("key_of")).select("key", "node", "n", "leader"), "placed")
        self.scratch.done(groups, lead)
        leaders = self.scratch.table(placed.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "leaders")

        near = 2 * self.percent - 100

        def is_near(overlap):
            return (100 + near) * overlap >= near * (F.col("na") + F.col("nb"))

        close = self.scratch.table(self.bounded(leaders).filter(is_near(F.col("most"))).select("a", "b").distinct(), "close")
        star = self.scratch.table(
            self.overlaps(close).drop("rest").filter(is_near(F.col("both"))).withColumn("linked", self.similar(F.col("both"), F.col("na"), F.col("nb"))), "star"
        )
        links = star.filter("linked").select("a", "b")
        found = components(self.spark, links)
        of = found.select(F.col("node").alias("node_of"), "component")
        lead_of = found.select(F.col("node").alias("lead_of"), F.col("component").alias("lead_component"))
        known = star.select(F.col("a").alias("a_of"), F.col("b").alias("b_of"), F.when(F.col("linked"), 2).otherwise(1).alias("degree"))
        whole = (
            placed.join(of, F.col("node") == F.col("node_of"), "left")
            .join(lead_of, F.col("leader") == F.col("lead_of"), "left")
            .join(known, (F.col("node") == F.col("a_of")) & (F.col("leader") == F.col("b_of")), "left")
            .select(
                "key",
                "node",
                "n",
                "leader",
                F.coalesce("component", "node").alias("comp"),
                F.coalesce("lead_component", "leader").alias("lead_comp"),
                # 0 far from the leader, 1 near it, 2 linked with it.
                F.when(F.col("node") == F.col("leader"), 2).otherwise(F.coalesce("degree", F.lit(0))).alias("degree"),
            )
        )
        whole = self.scratch.table(whole, "whole")
        self.scratch.done(placed)
        mixed = self.scratch.table(whole.filter("comp <> lead_comp").select(F.col("key").alias("mixed_key")).distinct(), "mixed")
        # Pairs of one that is far and another that isn't linked with the leader.
        apart = self.scratch.table(whole.filter("degree < 2").join(mixed, F.col("key") == F.col("mixed_key"), "left_semi").select("key", "node", "n", "comp", "degree"), "apart")
        other = apart.select(*[F.col(c).alias(f"{c}_b") for c in apart.columns])
        listed = apart.filter("degree = 0").join(other, (F.col("key") == F.col("key_b")) & (F.col("comp") != F.col("comp_b")) & self.sizes_fit(F.col("n"), F.col("n_b")))
        listed = listed.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
        near_pairs = self._near_pairs(whole, star)
        pairs = self.scratch.table(listed.union(near_pairs).distinct(), "pairs")
        return links.union(self.verified(pairs).select("a", "b"))

    def _near_pairs(self, whole: DataFrame, star: DataFrame) -> DataFrame:
        """Pairs of one near its leader, in another component, and another near or linked with that leader."""
        stray = self.scratch.table(whole.filter("degree = 1 and comp <> lead_comp").select(F.col("node").alias("stray"), F.col("leader").alias("lead")).distinct(), "stray")
        comps = whole.select(F.col("node").alias("comp_of"), "comp").distinct()
        around = star.join(stray.select("lead").distinct(), F.col("b") == F.col("lead"), "left_semi").join(comps, F.col("a") == F.col("comp_of"))
        around = around.join(stray, (F.col("a") == F.col("stray")) & (F.col("b") == F.col("lead")), "left")
        around = self.scratch.table(around.select("a", "b", "na", "nb", "both", "comp", F.col("stray").isNotNull().alias("is_stray")), "around")
        tokens = self.overlaps(around.select("a", "b").distinct(), outside=True).select(F.col("a").alias("a_of"), F.col("b").alias("b_of"), F.explode("rest").alias("token"))
        spread = self.scratch.table(
            tokens.join(around, (F.col("a") == F.col("a_of")) & (F.col("b") == F.col("b_of"))).select("a", "b", "token", "na", "comp", "is_stray"), "outside"
        )
        other = spread.select(*[F.col(c).alias(f"{c}_y") for c in ("a", "b", "token", "na", "comp")])
        same = (F.col("b") == F.col("b_y")) & (F.col("token") == F.col("token_y")) & (F.col("comp") != F.col("comp_y")) & self.sizes_fit(F.col("na"), F.col("na_y"))
        shared = spread.filter("is_stray").join(other, same).select(F.least("a", "a_y").alias("a"), F.greatest("a", "a_y").alias("b"))
        # Without a shared token outside the leader: the overlap with the leader bounds that of the pair.
        inside = around.filter(100 * F.col("both") >= self.percent * F.col("na"))
        other = inside.select(*[F.col(c).alias(f"{c}_y") for c in ("a", "b", "na", "both", "comp")])
        fits = self.similar(F.least("both", "both_y"), F.col("na"), F.col("na_y"))
        bare = inside.filter("is_stray").join(other, (F.col("b") == F.col("b_y")) & (F.col("comp") != F.col("comp_y")) & fits)
        return shared.union(bare.select(F.least("a", "a_y").alias("a"), F.greatest("a", "a_y").alias("b")))


def _join(docs: DataFrame, text: str, doc_id: str, shingle: int, percent: int, cells: int, frequent: int) -> SimilarityJoin:
    if not 50 <= percent <= 100:
        raise ValueError("percent lies between 50 and 100")
    return SimilarityJoin(docs, text, doc_id, shingle, percent, cells, frequent)


def similar_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, cells: int = CELLS, frequent: int = FREQUENT
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``class_id`` (smallest ID with the same set),
    ``component_id`` (smallest ID reachable by links of similarity ``percent`` / 100 or more).

    A text with fewer words than a shingle has one shingle, its words. A null text or one without words has
    none and is linked with nothing: its class and component are its own ID. Rows with equal IDs count as
    one document, linked where any of its texts is, and null IDs as one document that sorts last. Other
    columns are not read. An empty table gives no rows. Sets are told apart by 64-bit hashes.
    """
    join = _join(docs, text, doc_id, shingle, percent, cells, frequent)
    found = components(join.spark, join.component_links())
    out = join.members.join(found, F.col("rep") == F.col("node"), "left").select(
        F.nullif(F.col("id"), F.lit(_NULL_ID)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("rep", "id"), F.lit(_NULL_ID)).alias("class_id"),
        F.nullif(F.coalesce("component", "rep", "id"), F.lit(_NULL_ID)).alias("component_id"),
    )
    out = Scratch(join.spark).table(out, "groups")
    join.scratch.drop()
    return out


def similar_pairs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, cells: int = CELLS, frequent: int = FREQUENT
) -> DataFrame:
    """All links between class representatives: ``a`` < ``b``, ``overlap``, ``n_a``, ``n_b``.

    Every pair is listed here, so the result grows with the square of a group of near copies; members of a
    class are found in :func:`similar_groups`.
    """
    join = _join(docs, text, doc_id, shingle, percent, cells, frequent)
    groups = join.groups()
    other = groups.select(*[F.col(c).alias(f"{c}_b") for c in ("key", "node", "n")])
    pairs = groups.join(other, (F.col("key") == F.col("key_b")) & (F.col("node") < F.col("node_b")) & join.sizes_fit(F.col("n"), F.col("n_b")))
    pairs = join.scratch.table(pairs.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")
    out = Scratch(join.spark).table(join.verified(pairs).select("a", "b", F.col("both").alias("overlap"), F.col("na").alias("n_a"), F.col("nb").alias("n_b")), "links")
    join.scratch.drop()
    return out
