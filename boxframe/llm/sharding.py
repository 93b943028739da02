"""Sharding by a two-pass external shuffle.

Native throughout. The first pass scatters records into buckets of bounded size by a seeded hash. The
second applies Fisher-Yates to each bucket (Spark's ``shuffle`` of an array is one) and numbers its records
from the bucket's base, a prefix sum of bucket counts. Shards are equal stretches of that numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import prefix_sums, total
from boxframe.operators.checkpoints import cut_lineage

#: What a bucket holds on average; several buckets fit into a task's memory.
BUCKET_BYTES = 16 << 20
#: Assumed for a record besides its text.
RECORD_BYTES = 64


def shard_records(
    docs: DataFrame,
    shards: int,
    text: str = "text",
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``row`` (a struct of all columns), ``shard`` and ``slot`` (from 0, without gaps, in each shard).

    Law: the numbers of rows of any two shards differ by one at most. Every row gets one place, also
    repeated rows and rows whose ID or text is null; copies of one row are scattered like any others, as
    the hash takes the row's position in the scan and not its content. An empty table gives no rows.

    A bucket is shuffled, numbered and passed on by one task from the records it has read, so a task that
    runs again after a loss gives its bucket a whole, if other, order.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    place = F.monotonically_increasing_id()
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64(F.lit(seed), place).alias("h"),
    )
    amount = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + RECORD_BYTES
    rows, size = total(docs, F.lit(1), amount.cast("long"))
    buckets = max(1, -(-size // bucket_bytes))
    scattered = keyed.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    bases = cut_lineage(prefix_sums(scattered.groupBy("bucket").agg(F.count("*").alias("n")), "bucket", "n"))
    gathered = scattered.groupBy("bucket").agg(F.collect_list(F.struct("h", "row")).alias("records"))
    # Sorted by hash first, so that the order of arrival has no part in the result.
    ordered = F.expr("array_sort(records, (a, b) -> if(a.h < b.h, -1, if(a.h > b.h, 1, 0)))")
    shuffled = (
        gathered.join(bases.select(F.col("bucket").alias("bucket_of"), "base"), F.col("bucket") == F.col("bucket_of"))
        .select("base", F.shuffle(ordered, seed).alias("records"))
        .select("base", F.posexplode("records").alias("at", "record"))
    )
    numbered = shuffled.select("record.row", (F.col("base") + F.col("at")).alias("position"))
    whole = max(rows, 1)
    placed = numbered.withColumn("shard", F.expr(f"cast(position * {shards}L div {whole}L as int)"))
    first = F.expr(f"(cast(shard as bigint) * {whole}L + {shards - 1}L) div {shards}L")
    return placed.select("row", "shard", (F.col("position") - first).alias("slot"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard; each file holds a stretch of its slots in order."""
    sharded.select("row.*", "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
