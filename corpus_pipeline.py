"""From raw documents to token IDs: each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxframe.llm import mixing, ngram_join, pieces, quality, substring
from boxframe.operators.checkpoints import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No source is gone through more often; the mixture holds every document once at least.
REPETITION_LIMIT = 1.25
PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: Mixing bisects an exponent and encoding runs a dynamic program, which SQL can't state.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality.keep_good(docs)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, a number of its own for each row that is the same in every reading.

    A row of a file is named by the file's number (one row for each file is ordered for that) and its place in the
    file, so nothing has to be written; a table that isn't read from files is written first.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = cut_lineage(docs)
    placed = docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    number = F.row_number().over(Window.orderBy("__path")).cast("bigint")
    files = cut_lineage(placed.select(F.col("__file").alias("__path")).distinct().withColumn("__number", number))
    return placed.join(files, F.col("__file") == F.col("__path")).withColumn("__row", F.shiftleft("__number", 36) + F.col("__at")).drop("__file", "__at", "__path", "__number")


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one row of each group of similar documents stays, that of the smallest ID.

    Every row is a document of its own, also one without an ID (last in order) or with the ID of another. The
    numbers that go are written, so that Spark sends them to all tasks if they are few and shuffles both sides
    otherwise.
    """
    rows = numbered(docs)
    groups = ngram_join.similar_groups(rows, doc_id="__row").select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group"))
    placed = cut_lineage(groups.join(rows.select("__row", "doc_id"), "__row"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    first = cut_lineage(placed.groupBy(F.col("group").alias("group_of")).agg(F.min_by("__row", order).alias("stays")))
    gone = cut_lineage(placed.join(first, F.col("group") == F.col("group_of")).filter("__row <> stays").select(F.col("__row").alias("gone")))
    return rows.join(gone, F.col("__row") == F.col("gone"), "left_anti").drop("__row")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring de-duplication: repeated passages go from all but the smallest ID that holds them."""
    cut = substring.dedup_substrings(docs.select(COLUMNS))
    text = F.col("kept_text")
    return cut.select("row.doc_id", text.alias("text"), "row.lang", "row.source", F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: small sources are repeated, up to the limit; every document comes once at least."""
    return mixing.mix(docs.select(COLUMNS), repetition_limit=REPETITION_LIMIT).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece IDs of every document of the mixture."""
    encoded = pieces.encode_pieces(docs.select("doc_id", "source", "text"), PIECES)
    return encoded.select("doc_id", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("quality", keep_good),
    ("similar", drop_similar),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the table that its predecessor wrote to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
