"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.llm import (
    ann,
    conversations,
    conversations_sql,
    html_blocks,
    langid,
    mixing,
    neardup,
    neardup_sql,
    ngram_join,
    pieces,
    quality,
    quality_sql,
    sharding,
    substring,
    text_sql,
    token_files,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op9_quality_rules", quality_sql.ORACLE)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, folder, "documents"), carry=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *[f"base.{c}" for c in counts], "base_failed", "kept")


@query("op4_sharding")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, folder, "documents").select("doc_id", "text"), shards=16, seed=1)
    text = F.coalesce("row.text", F.lit(""))
    return placed.select(
        "row.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_piece_codec")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    decoded = pieces.decode_pieces(encoded, public_tokenizers.path("piece_bpe_32k.model"))
    return decoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")).alias("round_trip"),
    )


@query("op6_token_files")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    return token_files.read_tokens(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32")
    )


@query("op1_ngram_join", text_sql.SIMILAR_GROUPS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op3_substring_dedup", text_sql.SUBSTRINGS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring.dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    words = F.array_remove(F.split(F.coalesce("kept_text", F.lit("")), quality.WORD_GAP), "")
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs, ~held_out)
    predicted = langid.predict(docs, model, carry=["doc_id"])
    out = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4 == 2
    return predicted.select("row.doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op10_temperature_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixture = mixing.mix(docs, repetition_limit=1.25)
    return mixture.select("row.doc_id", "row.source", "tokens", "epoch", "turn", "weight", "exponent")


@query("op2_nearest_vectors")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op8_html_blocks")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = html_blocks.extract(pages, html_blocks.train(pages), carry=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query("op12_conversation_repair", conversations_sql.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    repaired = conversations.repair(given, conversations.damaged(given))
    digests = conversations.digests(repaired)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return repaired.summary.join(digests, "conv", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256")
    )


@query("op13_embedding_neardup", neardup_sql.ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_groups(table(spark, folder, "embeddings"))
