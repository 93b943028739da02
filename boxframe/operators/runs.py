"""Run ledger: events as rows, the latest state and the gates as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.text import OUT_OF_MEMORY_ADVICE, failure_advice, out_of_memory, utc_seconds
from boxframe.operators.ranking import HOT_ROWS, grouped_row_number

# The states of a run and which may follow which. Any run that has not succeeded may resume.
TRANSITIONS = {
    "initializing": ("initializing", "running", "failed"),
    "running": ("initializing", "success", "failed"),
    "failed": ("initializing",),
    "success": (),
}


def run_latest(events: DataFrame, key: str = "run_id") -> DataFrame:
    """Latest event of every run, by time and then event ID; aggregated, not ranked."""
    rest = [c for c in events.columns if c not in (key, "ts", "event_id")]
    latest = F.max(F.struct("ts", "event_id", *rest)).alias("e")
    return events.groupBy(key).agg(latest, F.count("*").alias("n_events")).select(
        key, "e.*", "n_events"
    )


def run_history(
    events: DataFrame, key: str = "run_id", hot_rows: int = HOT_ROWS, sized: DataFrame | None = None
) -> DataFrame:
    """Number the events of every run in time order; history is appended, never rewritten. ``sized`` as for ranks."""
    return grouped_row_number(
        events,
        [key],
        [F.asc("ts"), F.asc("event_id")],
        [F.date_trunc("hour", "ts"), F.date_trunc("second", "ts")],
        "seq",
        hot_rows,
        sized,
    )


def classify_failures(
    events: DataFrame, message_col: str = "message", advice: str = OUT_OF_MEMORY_ADVICE
) -> DataFrame:
    message = F.col(message_col)
    return events.withColumns(
        {"out_of_memory": out_of_memory(message), "recommendation": failure_advice(message, advice)}
    )


def resume_gate(runs: DataFrame, datasets: DataFrame, allow_change: bool = False) -> DataFrame:
    """``refusal`` of every run that asks to go on, null where it may.

    ``runs`` is ``(run_id, directory, status, dataset, dataset_fingerprint)``, ``datasets``
    ``(dataset, current_fingerprint)``.
    """
    joined = runs.join(datasets, "dataset", "left")
    recorded = F.nullif(F.col("dataset_fingerprint"), F.lit(""))
    changed = F.coalesce(recorded != F.col("current_fingerprint"), F.lit(True))
    refusal = (
        F.when(~F.coalesce(F.col("run_id") == F.col("directory"), F.lit(False)), "run_id_mismatch")
        .when(F.col("status") == "success", "already_successful")
        .when(recorded.isNull(), "no_fingerprint")
    )
    if not allow_change:
        refusal = refusal.when(changed, "fingerprint_changed")
    return joined.withColumn("refusal", refusal).select("run_id", "status", "refusal")


def resume_records(
    attempts: DataFrame, runs: DataFrame, datasets: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The record of every attempt to go on with a run from a checkpoint.

    ``attempts`` is ``(run_id, ts, event_id, checkpoint, checkpoint_sha256, allow_dataset_change)``, ``runs``
    ``(run_id, status, dataset, dataset_fingerprint)``, ``datasets`` ``(dataset, current_fingerprint)``. A checkpoint
    must be ``weights/last.pt`` in the folder named as its run. Gives ``refusal`` (null where the run may go on),
    ``seq`` (from 1, among the run's attempts that went on, in time order), both fingerprints and whether they
    differ, the checkpoint with its hash, and the time in UTC. Attempts are numbered apart from the joins, so that
    a run with very many of them is spread over the cluster.
    """
    folder = F.regexp_extract("checkpoint", r"([^/]+)/weights/last\.pt$", 1)
    recorded = F.nullif(F.col("dataset_fingerprint"), F.lit(""))
    changed = F.coalesce(recorded != F.col("current_fingerprint"), F.lit(True))
    allowed = F.coalesce("allow_dataset_change", F.lit(False))
    refusal = (
        F.when(F.coalesce(folder, F.lit("")) == "", "checkpoint_layout")
        .when(F.col("_known").isNull(), "unknown_run")
        .when(folder != F.col("run_id").cast("string"), "run_id_mismatch")
        .when(F.col("status") == "success", "already_successful")
        .when(recorded.isNull(), "no_fingerprint")
        .when(changed & ~allowed, "fingerprint_changed")
    )
    known = runs.join(datasets, "dataset", "left").select(
        "run_id", "status", "dataset_fingerprint", "current_fingerprint", F.lit(True).alias("_known")
    )
    judged = attempts.join(known, "run_id", "left").withColumn("refusal", refusal)
    # Numbers are given to few columns: what follows from them, such as texts of times, is made after the sort.
    slim = judged.select(*attempts.columns, "refusal", "dataset_fingerprint", "current_fingerprint").drop("allow_dataset_change")
    sized = attempts.select("run_id", F.lit(1).alias("_rows"))
    accepted = run_history(slim.filter("refusal is null"), hot_rows=hot_rows, sized=sized)
    refused = slim.filter("refusal is not null").withColumn("seq", F.lit(None).cast(accepted.schema["seq"].dataType))
    return accepted.unionByName(refused).select(
        "run_id",
        "event_id",
        "refusal",
        recorded.alias("original_fingerprint"),
        "current_fingerprint",
        F.when(recorded.isNotNull(), changed).alias("dataset_changed"),
        "checkpoint",
        "checkpoint_sha256",
        utc_seconds(F.col("ts")).alias("resumed_at_utc"),
        "seq",
    )


def verify_artifacts(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """``problem`` per recorded artifact: missing, empty or with another hash.

    Both sides are ``(run_id, name, sha256)``; ``found`` also has ``size_bytes``.
    """
    other = found.select(
        "run_id", "name", F.col("sha256").alias("_sha"), F.col("size_bytes").alias("_size")
    )
    problem = (
        F.when(F.col("_sha").isNull(), "missing")
        .when(F.col("_size") == 0, "empty")
        .when(F.col("_sha") != F.col("sha256"), "hash_mismatch")
    )
    return recorded.join(other, ["run_id", "name"], "left").select(
        "run_id", "name", problem.alias("problem")
    )


def allowed_next(state: Column, following: Column) -> Column:
    """Whether a state may follow another."""
    result = F.lit(False)
    for source, targets in TRANSITIONS.items():
        if targets:
            result = result | ((state == source) & following.isin(*targets))
    return result


def transitions(
    events: DataFrame, key: str = "run_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(run_id, seq, status, previous, allowed)`` of every event.

    The event before is found by an equi-join on run and number, so a run with very many events is
    spread over the cluster. A run must start as ``initializing``.
    """
    history = run_history(events, key, hot_rows).select(key, "seq", "status")
    earlier = history.select(key, (F.col("seq") + 1).alias("seq"), F.col("status").alias("previous"))
    joined = history.join(earlier, [key, "seq"], "left")
    first = F.col("previous").isNull() & (F.col("status") == "initializing")
    later = F.col("previous").isNotNull() & allowed_next(F.col("previous"), F.col("status"))
    return joined.withColumn("allowed", first | later)


def registry_view(promotions: DataFrame) -> DataFrame:
    """Every promotion with ``active``: the latest one of its model name."""
    last = promotions.groupBy("name").agg(
        F.max(F.struct("promoted_at", "promotion_id")).alias("_last")
    )
    active = F.col("promotion_id") == F.col("_last.promotion_id")
    return promotions.join(last, "name").withColumn("active", active).drop("_last")
