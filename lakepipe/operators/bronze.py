"""Bronze load (A3, A6, A8): typed rows with audit columns, idempotent per submission."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.columns import version_from_sid
from lakepipe.functions.joins import DEFAULT_BROADCAST_ROWS, fits
from lakepipe.schemas import BRONZE_HISTORY, BRONZE_LCR, LOADS
from lakepipe.sources.versioned import MOST_PERIOD_FILES, PERIOD, Store, period_part


def with_audit(parsed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Business columns + submission_id, version, source_uri, source_sha256, loaded_at.

    ``parsed`` carries submission_id and sha256 of its file, and the file's
    path, which lineage ends at.
    """
    ts = loaded_at if loaded_at is not None else F.localtimestamp()
    return parsed.select(
        "institution_id", "reporting_period", "line_code", "currency",
        F.col("amount").cast("decimal(20,2)").alias("amount"), "submission_id",
        version_from_sid("submission_id").alias("submission_version"),
        F.col("path").alias("source_uri"),
        F.col("sha256").alias("source_sha256"), ts.cast("timestamp_ntz").alias("loaded_at"))


def replace_rows(existing: DataFrame, new: DataFrame, submissions: DataFrame | None = None) -> DataFrame:
    """Rows of ``existing`` whose submission is re-delivered are replaced by ``new``.

    ``submissions`` (submission_id) are those delivered; a delivery without
    rows replaces the earlier ones by none.  Default: those that have rows.
    """
    sids = (new if submissions is None else submissions).select("submission_id").distinct()
    kept = existing.join(sids, "submission_id", "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def current(history: DataFrame) -> DataFrame:
    """The rows that no later delivery replaced."""
    return history.where(F.col("replaced_at").isNull()).drop("replaced_at")


def close_replaced(history: DataFrame, submissions: DataFrame, at: Column, small: bool = False) -> DataFrame:
    """The history with the current rows of the submissions closed at a time; nothing is deleted.

    ``small``: the submissions can be broadcast, so the history is not shuffled.
    """
    sids = submissions.select("submission_id").distinct().withColumn("__again", F.lit(True))
    ends = F.when(F.col("__again") & F.col("replaced_at").isNull(), at.cast("timestamp_ntz")).otherwise(F.col("replaced_at"))
    return history.join(F.broadcast(sids) if small else sids, "submission_id", "left").select(
        *[ends.alias(c) if c == "replaced_at" else F.col(c) for c in history.columns])


def replace(store: Store, new: DataFrame, submissions: DataFrame | None = None, at: Column | None = None,
            derive: Callable[[DataFrame], DataFrame] | None = None, clustered: bool = False) -> tuple[dict[str, dict], list[str]]:
    """The load of a batch of submissions, to be committed by the caller, and the periods it touches.

    ``submissions`` (submission_id) are those delivered; a delivery without
    rows replaces the earlier ones by none (default: those that have rows).
    Replaced rows stay with the time of their replacement.  Earlier rows are
    found by the list of loads, not by a scan of Bronze; only the touched
    periods (months, and one partition for all texts that are none) are read
    and written.  The new rows are written first and the earlier ones of their
    periods beside them, from period to period without a shuffle unless they
    have come to lie in many files.  ``derive``, ``clustered`` (of the new
    rows): see ``Store.written``.
    """
    at = at if at is not None else F.localtimestamp()
    columns, load = [f.name for f in BRONZE_LCR.fields], uuid.uuid4().hex[:16]

    def finished(rows: DataFrame) -> DataFrame:
        return (derive(rows) if derive else rows).select(*columns, F.lit(None).cast("timestamp_ntz").alias("replaced_at"), PERIOD)
    fresh = store.written(new, "bronze", by_period=True, clustered=clustered, derive=finished, load=load)
    new = store.load("bronze", BRONZE_HISTORY, fresh)
    sids = (new if submissions is None else submissions).select("submission_id").distinct()
    # counted by period first: a set is collected from sorted rows, which are few then
    counts = new.groupBy("submission_id", period_part().alias("p")).agg(F.count(F.lit(1)).alias("rows"))
    arrived = counts.groupBy("submission_id").agg(F.sum("rows").alias("rows"), F.collect_set("p").alias("periods"))
    listed = store.written(sids.join(arrived, "submission_id", "left").select(
        "submission_id", at.cast("timestamp_ntz").alias("loaded_at"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("periods", F.array().cast("array<string>")).alias("periods")), "loads", append=True)
    loads, state = store.load("loads", LOADS, listed), store.state()
    earlier = store.read("loads", LOADS, state=state).join(loads.select("submission_id"), "submission_id", "left_semi")
    months = earlier.select("periods").unionByName(loads.select("periods")).select(F.explode("periods").alias("p")).distinct()
    periods = sorted(r["p"] for r in months.collect())
    again = sorted(set(periods) & set(store.periods("bronze", state)))
    if again:
        history, closing = store.read("bronze", BRONZE_HISTORY, again, state=state), earlier.select("submission_id").distinct()
        small = fits(closing, DEFAULT_BROADCAST_ROWS)
        stays = small and len(history.inputFiles()) <= MOST_PERIOD_FILES * len(again)
        fresh = store.written(close_replaced(history, closing, at, small), "bronze", by_period=True, clustered=stays, load=load)
    return {"bronze": {"parts": {p: None for p in periods} | fresh["parts"]}, "loads": listed}, periods


def replace_submissions(spark: SparkSession, path: str, new: DataFrame, submissions: DataFrame | None = None,
                        at: Column | None = None, derive: Callable[[DataFrame], DataFrame] | None = None,
                        clustered: bool = False) -> list[str]:
    """``replace`` on the store in a folder, committed: readers see all of the delivery or nothing of it."""
    store = Store(spark, path)
    changes, periods = replace(store, new, submissions, at, derive, clustered)
    store.commit(changes, "replace submissions")
    return periods
