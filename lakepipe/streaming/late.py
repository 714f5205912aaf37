"""Stream sinks whose state is a table: late events as data, and duplicates with bounded state.

Spark's windows drop what comes after the watermark, and its exact dedup keeps
every id for ever.  These two sinks work on whole micro-batches with
``foreachBatch`` and keep their state as folders of Parquet, one for each
batch: a batch reads the state that the batch before it left and writes its
own, so a batch that is replayed after a failure overwrites what it wrote
before and gives the same result.  State that the next batch does not need is
deleted.

The watermark before a batch is the largest event time of all earlier batches
less the allowed lateness, as in Spark's own windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakepipe.schemas import columns
from lakepipe.sources import tables
from lakepipe.streaming import payments

MARK = columns("max_ms long")
#: Minutes that a stream may be behind, and the contract's dedup horizon.
LATE_MINUTES, HORIZON_MINUTES = 5, 10
MINUTE_MS = 60_000
OPEN_WINDOW = "window_ms long, institution_id string, payment_system string, event_count long, total decimal(38,10), failed_count long"


@dataclass
class BatchState:
    """Folders ``<root>/<name>/batch_id=<n>`` of one run of a stream."""

    spark: SparkSession
    root: str

    def _folder(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def batches(self, name: str) -> list[int]:
        fs, path = self._folder(name)
        found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(f.split("=")[1]) for f in found if f.startswith("batch_id="))

    def path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch_id={batch_id}"

    def write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.path(name, batch_id))

    def before(self, name: str, batch_id: int, schema) -> DataFrame:
        """What the last batch before this one left (empty for the first)."""
        earlier = [b for b in self.batches(name) if b < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name, earlier[-1]))

    def forget(self, name: str, batch_id: int) -> None:
        """Delete what lies before the batch that the next replay could need."""
        for b in self.batches(name)[:-2]:
            if b < batch_id - 1:
                tables.delete_folder(self.spark, self.path(name, b))

    def advance(self, batch: DataFrame, batch_id: int) -> tuple[int | None, int | None]:
        """The largest event time before this batch and after it (one number each), kept as the batch's mark."""
        old = self.before("marks", batch_id, MARK).agg(F.max("max_ms")).first()[0]
        seen = batch.agg(F.max("event_time")).first()[0]
        new = max((x for x in (old, seen) if x is not None), default=None)
        self.write(self.spark.createDataFrame([(new,)], MARK), "marks", batch_id)
        self.forget("marks", batch_id)
        return old, new


def _window(ms: Column) -> Column:
    return F.floor(ms / MINUTE_MS).cast("long") * MINUTE_MS


def _watermark(largest: int | None, minutes: int) -> Column:
    return F.lit(None if largest is None else largest - minutes * MINUTE_MS).cast("long")


def window_batch(state: BatchState, events: DataFrame, batch_id: int, stats_path: str, late_path: str) -> None:
    """One micro-batch of minute windows: closed windows go to ``stats_path``, refused events to ``late_path``.

    An event is late if its window was closed before the batch; every other
    event is counted in its window, so windows and late events are all events.
    """
    spark = state.spark
    events = events.persist()
    old, new = state.advance(events, batch_id)
    end = _window(F.col("event_time")) + MINUTE_MS
    late = F.coalesce(end <= _watermark(old, LATE_MINUTES), F.lit(False))
    refused = events.where(late).withColumn("watermark", payments.epoch_millis_to_ntz(_watermark(old, LATE_MINUTES))) \
        .withColumn("late_ms", _watermark(old, 0) - F.col("event_time"))
    refused.drop("ts").write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
    came = events.where(~late).select(
        _window(F.col("event_time")).alias("window_ms"), "institution_id", "payment_system", F.lit(1).cast("long").alias("event_count"),
        F.col("amount").cast(payments.TOTAL_TYPE).alias("total"), F.when(F.col("status") == "FAILED", 1).otherwise(0).cast("long").alias("failed_count"))
    before = state.before("open", batch_id, OPEN_WINDOW)
    both = tables.stage(spark, before.unionByName(came).groupBy("window_ms", "institution_id", "payment_system").agg(
        F.sum("event_count").alias("event_count"), F.sum("total").cast("decimal(38,10)").alias("total"), F.sum("failed_count").alias("failed_count")), "windows")
    closed = F.coalesce(F.col("window_ms") + MINUTE_MS <= _watermark(new, LATE_MINUTES), F.lit(False))
    both.where(closed).select(
        payments.epoch_millis_to_ntz(F.col("window_ms")).alias("window_start"),
        payments.epoch_millis_to_ntz(F.col("window_ms") + MINUTE_MS).alias("window_end"), "institution_id", "payment_system", "event_count",
        F.col("total").cast("double").alias("total_amount"), "failed_count").write.mode("overwrite").parquet(f"{stats_path}/batch_id={batch_id}")
    state.write(both.where(~closed), "open", batch_id)
    state.forget("open", batch_id)
    tables.discard(both)
    events.unpersist()


SEEN = columns("event_id string, bucket long")


def dedup_batch(state: BatchState, events: DataFrame, batch_id: int, out_path: str) -> None:
    """One micro-batch without copies: the first event of an id stays, as long as the id's bucket is kept.

    Ids lie in buckets of ``HORIZON_MINUTES`` of event time; a bucket that
    ended more than that before the largest event time is forgotten, so the
    state holds the ids of a few buckets however long the stream runs.  An
    event whose bucket is forgotten cannot be told from a copy, and stays.
    """
    width = HORIZON_MINUTES * MINUTE_MS
    bucket = F.coalesce(F.floor(F.col("event_time") / width).cast("long"), F.lit(-1))
    events = events.withColumn("bucket", bucket).persist()
    _, new = state.advance(events, batch_id)
    known = state.before("seen", batch_id, SEEN)
    fresh = tables.stage(state.spark, events.dropDuplicates(["event_id", "bucket"]).join(known, ["event_id", "bucket"], "left_anti"), "fresh")
    payments.bronze_events(fresh).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    kept = (F.col("bucket") + 1) * width > F.lit(-1 if new is None else new - width)
    state.write(known.unionByName(fresh.select("event_id", "bucket")).where(kept), "seen", batch_id)
    state.forget("seen", batch_id)
    tables.discard(fresh)
    events.unpersist()


def start_table_sinks(raw: DataFrame, checkpoint_root: str, stats_path: str | None = None, late_path: str | None = None,
                      dedup_path: str | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the windows with their late sink (``stats_path`` and ``late_path``), the bounded dedup (``dedup_path``), or both."""
    spark, trig = raw.sparkSession, trigger or {"processingTime": "60 seconds"}
    run = payments.sink_run(spark, checkpoint_root)
    good = payments.good_events(payments.parse_events(raw)).drop("ts")

    def start(name: str, write) -> StreamingQuery:
        state = BatchState(spark, f"{checkpoint_root}/{name}-state/run={run}")
        events = good.withColumn("ts", F.timestamp_millis("event_time"))
        return (events.writeStream.foreachBatch(lambda b, i: write(state, b, i)).option("checkpointLocation", f"{checkpoint_root}/{name}")
                .trigger(**trig).start())

    queries = []
    if stats_path:
        queries.append(start("late-windows", lambda s, b, i: window_batch(s, b, i, f"{stats_path}/run={run}", f"{late_path}/run={run}")))
    if dedup_path:
        queries.append(start("bounded-dedup", lambda s, b, i: dedup_batch(s, b, i, f"{dedup_path}/run={run}")))
    return queries
