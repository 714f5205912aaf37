"""Submission ledger as data.

The mutable ``submission`` row store becomes an append-only event table; the
current status is derived as the newest event per submission (an aggregate
with map-side partial results, not an UPDATE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.schemas import SUBMISSION_EVENT

STATUS_ORDER = ["RECEIVED", "VALIDATED", "REJECTED", "ACCEPTED", "QUARANTINED", "PUBLISHED"]


def status_events(df: DataFrame, status: str | Column, created_at: Column,
                  detail: Column | None = None, reason: Column | None = None) -> DataFrame:
    """Build event rows (submission_id, status, detail JSON, created_at) from a stage output."""
    st = F.lit(status) if isinstance(status, str) else status
    det = detail if detail is not None else F.lit(None)
    payload = F.to_json(F.struct(reason.alias("reason") if reason is not None else F.lit(None).alias("reason"),
                                 det.alias("detail")))
    ev = df.select(F.col("submission_id"), st.alias("status"), payload.alias("detail"),
                   created_at.cast("timestamp_ntz").alias("created_at"))
    # event_id: a deterministic id from the event content (no global counter).
    return ev.select(F.xxhash64("submission_id", "status", "created_at").alias("event_id"),
                     "submission_id", "status", "detail", "created_at")


def append_events(events: DataFrame, path: str) -> None:
    events.select(*[f.name for f in SUBMISSION_EVENT.fields]).write.mode("append").parquet(path)


def current_status(events: DataFrame) -> DataFrame:
    """Newest event per submission (ties on time broken by lifecycle order)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    last = F.max(F.struct(F.col("created_at"), rank.alias("rank"), F.col("status"), F.col("detail")))
    return (events.groupBy("submission_id")
            .agg(last.alias("l"), F.min("created_at").alias("received_at"),
                 F.count(F.lit(1)).alias("n_events"))
            .select("submission_id", F.col("l.status").alias("status"),
                    F.get_json_object("l.detail", "$.reason").alias("status_reason"),
                    "received_at", F.col("l.created_at").alias("updated_at"), "n_events"))


def time_in_status(events: DataFrame) -> DataFrame:
    """How long each submission stayed in each status.

    A submission has a handful of lifecycle events, so the per-submission
    window is bounded.
    """
    from pyspark.sql import Window
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    w = Window.partitionBy("submission_id").orderBy("created_at", rank)
    nxt = F.lead("created_at").over(w)
    return events.select(
        "submission_id", "status", "created_at",
        nxt.alias("left_at"),
        F.timestamp_diff("SECOND", F.col("created_at"), nxt).alias("seconds_in_status"))


def orphans(events: DataFrame, submissions: DataFrame) -> DataFrame:
    """Events whose submission is unknown (the missing foreign key, reported as data)."""
    return events.join(submissions.select("submission_id").distinct(), "submission_id", "left_anti")


def publish_lifecycle(events: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Lifecycle events as JSON records for downstream consumers.

    A streaming ``events`` DataFrame becomes a file stream with its own
    checkpoint (exactly-once file sink); a static one is appended.
    Returns the StreamingQuery for streams, else None.
    """
    out = events.select("submission_id", F.to_json(F.struct(*events.columns)).alias("value"))
    if events.isStreaming:
        return (out.writeStream.format("json").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"}))
                .start())
    out.write.mode("append").json(path)
    return None
