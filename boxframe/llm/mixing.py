"""Mixing sources to target weights by temperature.

A source with the share p of all tokens gets a weight proportional to p ** exponent. Exponent 1 keeps the
shares, exponent 0 makes them equal; in between the entropy of the weights falls and the most repeated
source is repeated less. The exponent is bisected to a target entropy or a repetition limit.

Weights are realised by block permutations. A source's documents are dealt into blocks by a seeded hash. An
epoch goes through all of a source's blocks in a fresh permutation; the last epoch stops where the source's
budget of tokens is used up, inside one block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch, prefix_sums

BLOCK_TOKENS = 250_000
#: Exponents tried in one pass over the table of sources.
TRIES = 16
TOLERANCE = 1e-9


@dataclass
class Mixture:
    exponent: float
    #: Tokens that the mixture holds, before documents are rounded to whole ones.
    budget: float
    entropy: float
    repetition: float


def word_count(text: Column) -> Column:
    """Words of a text, 1 at least, so that empty documents take a place too."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.greatest(F.size(words), F.lit(1)).cast("long")


def _curves(sources: DataFrame, total: float, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, least and greatest of weight / share) at each exponent, in one pass."""
    share = F.col("tokens") / F.lit(float(total))
    sums = []
    for i, x in enumerate(exponents):
        raised = F.pow(share, F.lit(x))
        sums += [
            F.sum(raised).alias(f"z{i}"),
            F.sum(raised * F.log(raised)).alias(f"s{i}"),
            F.min(raised / share).alias(f"l{i}"),
            F.max(raised / share).alias(f"g{i}"),
        ]
    row = sources.agg(*sums).first()
    out = []
    for i in range(len(exponents)):
        z = row[f"z{i}"]
        out.append((math.log(z) - row[f"s{i}"] / z, row[f"l{i}"] / z, row[f"g{i}"] / z))
    return out


def find_mixture(
    sources: DataFrame,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    budget: float | None = None,
) -> Mixture:
    """The least exponent in [0, 1] that meets the target. ``sources`` has ``tokens`` of each source.

    ``target_entropy`` (nats): the weights' entropy is not above it. ``repetition_limit``: no source is gone
    through more often. Without a ``budget`` the mixture is just large enough to hold every document once.
    """
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give a target entropy or a repetition limit")
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return Mixture(1.0, 0.0, 0.0, 0.0)

    def described(exponent: float, curve: tuple[float, float, float]) -> Mixture:
        entropy, least, most = curve
        size = budget if budget is not None else total / least
        return Mixture(exponent, size, entropy, most * size / total)

    def met(m: Mixture) -> bool:
        slack = 1 + TOLERANCE
        return m.repetition <= repetition_limit * slack if repetition_limit is not None else m.entropy <= target_entropy * slack

    low, high = 0.0, 1.0
    ends = [described(x, c) for x, c in zip((low, high), _curves(sources, total, [low, high]), strict=True)]
    if met(ends[0]):
        return ends[0]
    if not met(ends[1]):
        raise ValueError("the target can't be met by any exponent between 0 and 1")
    best = ends[1]
    while high - low > TOLERANCE:
        tried = [low + (high - low) * (i + 1) / (TRIES + 1) for i in range(TRIES)]
        found = [described(x, c) for x, c in zip(tried, _curves(sources, total, tried), strict=True)]
        good = [m for m in found if met(m)]
        if good:
            best = good[0]
        high = best.exponent
        low = max([low, *(m.exponent for m in found if not met(m) and m.exponent < high)])
    return best


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    budget: float | None = None,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The mixture: ``row`` (a struct of all columns), ``tokens``, ``epoch`` (from 0), ``turn`` (of the
    document's block in that epoch), ``weight`` (of its source), ``exponent``.

    A document comes once for each epoch that reaches it. A source's tokens exceed its budget by less than
    one document. A null source is a source like any other; null texts and texts without words count as one
    token. Equal rows lie in one block and come equally often, unless the budget ends among them. An empty
    table gives no rows. Columns stay inside ``row``, so names can't clash.
    """
    scratch = Scratch(docs.sparkSession)
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(
        kept,
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("tokens"),
        F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h"),
    )
    sources = scratch.table(base.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    mixture = find_mixture(sources, target_entropy, repetition_limit, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    raised = F.pow(F.col("tokens") / float(total), F.lit(mixture.exponent))
    z = sources.agg(F.sum(raised)).first()[0] or 1.0
    quotas = scratch.table(
        sources.select(
            F.col("source").alias("source_of"),
            (raised / z).alias("weight"),
            F.greatest(F.lit(1), F.floor(F.col("tokens") / block_tokens)).cast("long").alias("blocks"),
            # Whole epochs, and tokens left for the last one. A budget within rounding of a whole epoch is one.
            F.floor(raised / z * mixture.budget / F.col("tokens") + 1e-6).cast("int").alias("epochs"),
            (raised / z * mixture.budget).alias("quota"),
            F.col("tokens").alias("source_tokens"),
        ),
        "quotas",
    )
    rest = F.col("quota") - F.col("epochs") * F.col("source_tokens")
    left = F.when(rest > 1e-6 * F.col("source_tokens"), rest).otherwise(0.0)
    dealt = base.join(quotas.withColumn("left", left), F.col("source").eqNullSafe(F.col("source_of"))).withColumn("block", F.pmod("h", "blocks"))

    def rank(epoch: Column) -> Column:
        return F.xxhash64(F.lit(seed), "source", epoch, "block")

    # Place of each block in the permutation of the last, partial epoch, and the tokens before it there.
    blocks = scratch.table(dealt.groupBy("source", "block", "epochs", "left").agg(F.sum("tokens").alias("amount")), "blocks")
    order = Window.partitionBy("source").orderBy(rank(F.col("epochs")), "block")
    turns = prefix_sums(blocks.withColumn("turn", F.row_number().over(order) - 1), "turn", "amount", ["source"], "before")
    last = scratch.table(
        turns.filter("before < left").select(
            F.col("source").alias("last_source"), F.col("block").alias("last_block"), F.col("turn").cast("long").alias("last_turn"), (F.col("left") - F.col("before")).alias("room"), "amount"
        ),
        "last",
    )
    full = dealt.filter("epochs > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch"))
    # In a whole epoch only the order of blocks matters, which the rank gives.
    full = full.select("row", "tokens", "epoch", rank(F.col("epoch")).alias("turn"), "weight")
    same = F.col("source").eqNullSafe(F.col("last_source")) & (F.col("block") == F.col("last_block"))
    rest = dealt.join(last, same).select("row", "tokens", F.col("epochs").alias("epoch"), rank(F.col("epochs")).alias("turn"), "weight", "source", "block", "h", "room", "amount")
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed), "epoch", "h")).rowsBetween(Window.unboundedPreceding, -1)
    # One block of a source at most is cut.
    cut = rest.filter("amount > room").withColumn("used", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).filter("used < room")
    columns = ["row", "tokens", "epoch", "turn", "weight"]
    out = full.select(columns).union(rest.filter("amount <= room").select(columns)).union(cut.select(columns))
    return out.withColumn("exponent", F.lit(mixture.exponent))
