"""Payment-event stream.

The same functions work on a streaming DataFrame (Structured Streaming) and
on a static one (batch replay, tests): parse -> (dedup) -> Bronze projection,
and parse -> watermark -> 1-minute tumbling windows.

Event time is an instant (``timestamp_millis``, like TO_TIMESTAMP_LTZ) so the
watermark can use it; sinks store UTC wall-clock ``timestamp_ntz`` values
computed from epoch milliseconds, independent of the session time zone.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakepipe.contracts import load_event_contract, load_rules
from lakepipe.functions.columns import epoch_millis_to_ntz
from lakepipe.operators import quality
from lakepipe.schemas import PAYMENT_EVENT

CORRUPT = "_corrupt_record"
# The contract's allowed lateness, dedup horizon and window.
LATENESS = "5 minutes"
DEDUP_HORIZON = "10 minutes"
WINDOW = "1 minute"
# Totals add up amounts exactly in this type; an amount beyond it goes to the dead letters.
TOTAL_TYPE = "decimal(38,10)"
# An institution with more rows than this in a micro-batch is written by several tasks.
ROWS_PER_TASK = 1_000_000
MALFORMED, OUT_OF_RANGE = "malformed JSON", "amount out of range"


def _wall_clock(ts: Column) -> Column:
    """Instant -> UTC wall-clock TIMESTAMP_NTZ (millisecond precision)."""
    return epoch_millis_to_ntz(F.unix_millis(ts))


# ------------------------------------------------------------------ sources

def read_source(spark: SparkSession, source: str, path: str | None = None,
                options: dict[str, str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw topic as a stream of ``value`` strings.

    ``source`` is ``"kafka"`` (when the connector is on the classpath) or a
    file format (``"text"`` JSON lines) for replay and tests.
    """
    r = spark.readStream.format(source)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if source == "kafka":
        r = r.option("startingOffsets", (options or {}).get("startingOffsets", "earliest"))
        return r.load().select(F.col("value").cast("string").alias("value"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select(F.col("value"))


# ------------------------------------------------------------------- parsing

def parse_events(raw: DataFrame, on_error: str = "dlq") -> DataFrame:
    """JSON value -> typed event columns + ``ts`` (I1) + ``parse_error`` flag.

    ``on_error="fail"`` reproduces a job that stops on the first malformed
    record (FAILFAST, I9); ``"dlq"`` keeps them for dead-letter routing (L1).
    """
    schema = T.StructType(PAYMENT_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "FAILFAST"} if on_error == "fail" else {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    extra = [c for c in raw.columns if c not in [f.name for f in PAYMENT_EVENT.fields]]
    p = raw.select(*extra, F.from_json("value", schema, opts).alias("e"))
    cols = [F.col(f"e.{f.name}").alias(f.name) for f in PAYMENT_EVENT.fields]
    amount = F.col("e.amount")
    error = (F.when(F.col(f"e.{CORRUPT}").isNotNull() | F.col("e").isNull(), F.lit(MALFORMED))
             .when(amount.isNotNull() & amount.try_cast(TOTAL_TYPE).isNull(), F.lit(OUT_OF_RANGE)))
    return p.select(*extra, *cols, error.isNotNull().alias("parse_error"), error.alias("error")).withColumn(
        "ts", F.timestamp_millis(F.col("event_time")))


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("parse_error")).drop("parse_error", "error")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Records that cannot be processed, with the reason, for the dead-letter sink (L1)."""
    return parsed.where(F.col("parse_error")).select("value", "error")


# --------------------------------------------------------------------- dedup

def deduplicate(events: DataFrame, mode: str = "exact", order: str | None = "arrival") -> DataFrame:
    """Keep the first occurrence per event_id.

    ``exact``: no expiry, late copies are still removed (unbounded state; use
    the RocksDB state store).  ``bounded``: the contract's 10-minute horizon
    (L2); state expires with the watermark, copies further apart pass.  A
    static table keeps the copy that is first by the column ``order``, if it
    has one; a stream keeps the one it meets first.
    """
    if mode == "exact" and not events.isStreaming and order in events.columns:
        rest = [c for c in events.columns if c not in (order, "event_id")]
        first = events.groupBy("event_id").agg(F.min(F.struct(order, *rest)).alias("e"))
        return first.select(*[F.col(c) if c == "event_id" else F.col(f"e.{c}") for c in events.columns])
    if mode == "exact":
        return events.dropDuplicates(["event_id"])
    if mode == "bounded":
        return events.withWatermark("ts", DEDUP_HORIZON).dropDuplicatesWithinWatermark(["event_id"])
    raise ValueError(f"unknown dedup mode: {mode}")


def bronze_events(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze projection (I4): event_ts wall clock (ms), ingested_at."""
    ing = ingested_at if ingested_at is not None else F.current_timestamp()
    return events.select(
        "event_id", "institution_id", _wall_clock(F.col("ts")).alias("event_ts"),
        "payment_system", "direction", "amount", "currency", "status",
        _wall_clock(ing).alias("ingested_at"))


def minute_stats(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """1-minute tumbling windows per institution and system.

    Append mode: a window is emitted once the watermark passes its end; rows
    later than the watermark are dropped (I7).

    A window of a static table holds few of its events, so a partial sum of a
    task holds nearly all of its events and spills: they are shuffled first.
    """
    rows, window, failed = events.withWatermark("ts", lateness), F.window("ts", WINDOW), F.col("status") == "FAILED"
    if not events.isStreaming:
        rows = rows.select(window.alias("window"), "institution_id", "payment_system", "amount", failed.alias("failed"))
        rows = rows.repartition("window", "institution_id", "payment_system")
        window, failed = F.col("window"), F.col("failed")
    w = (rows.groupBy(window, "institution_id", "payment_system")
         .agg(F.count(F.lit(1)).alias("event_count"),
              # exact (order-free) accumulation, reported as double
              F.sum(F.col("amount").cast(TOTAL_TYPE)).cast("double").alias("total_amount"),
              F.count_if(failed).alias("failed_count")))
    return w.select(_wall_clock(F.col("window.start")).alias("window_start"),
                    _wall_clock(F.col("window.end")).alias("window_end"),
                    "institution_id", "payment_system", "event_count", "total_amount", "failed_count")


def rows_dropped_by_watermark(query) -> int:
    """Late rows the windows dropped, summed over the query's recent progress.

    Spark counts rows as they reach the stateful operator, i.e. after the
    map-side partial aggregate: late events of one window and key in one task
    count once.  Exact per-event counts: the ``minute_stats_late`` classification.
    """
    return sum(op.get("numRowsDroppedByWatermark", 0) or 0
               for p in query.recentProgress for op in p.get("stateOperators", []))


# ----------------------------------------------------------- quality

def evaluate_event_rules(batch: DataFrame, batch_id: int | Column, stage: str = "bronze") -> DataFrame:
    """PAY-001..004 on one micro-batch (the batch id stands in for the submission id).

    The rules name ``event_time``, so they run on the parsed events before the
    Bronze projection renames it.
    """
    rows = batch.withColumn("submission_id", F.lit(batch_id).cast("string") if isinstance(batch_id, int)
                            else batch_id.cast("string"))
    return quality.evaluate(rows, load_rules("payments-events"), stage)


def enum_violations(events: DataFrame) -> DataFrame:
    """Avro enum conformance (L5): rows whose enum fields hold unknown symbols."""
    enums = load_event_contract()["enums"]
    conds = [(~F.col(c).isin(v) | F.col(c).isNull()).alias(f"bad_{c}") for c, v in enums.items()]
    flagged = events.select("event_id", *conds)
    any_bad = F.lit(False)
    for c in enums:
        any_bad = any_bad | F.col(f"bad_{c}")
    return flagged.where(any_bad)


# ------------------------------------------------------------------- the job

def by_institution(events: DataFrame) -> DataFrame:
    """Rows clustered by institution for a write in folders of institutions, those of a large one over several tasks.

    A micro-batch of a stateful stream is planned without AQE, where the
    REBALANCE hint is left out: every task would write a file for every
    institution.  A batch of up to ROWS_PER_TASK rows has no large institution
    and goes to as many tasks as there are cores, so the tasks of the stateful
    operator deal their rows out to few files.  In others the large
    institutions are at most one per ROWS_PER_TASK rows.
    """
    if events.count() <= ROWS_PER_TASK:
        spark = events.sparkSession
        tasks = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return events.repartition(tasks, "institution_id")
    sizes = events.groupBy(F.col("institution_id").alias("__large")).agg(F.count(F.lit(1)).alias("__n"))
    large = sizes.where(F.col("__n") > ROWS_PER_TASK)
    joined = events.join(F.broadcast(large), F.col("institution_id").eqNullSafe(F.col("__large")), "left")
    part = F.pmod(F.xxhash64("event_id"), F.coalesce(F.ceil(F.col("__n") / ROWS_PER_TASK), F.lit(1)))
    return joined.withColumn("__part", part).repartition("institution_id", "__part").select(*events.columns)


def sink_run(spark: SparkSession, checkpoint_root: str) -> str:
    """A name for the runs that share a checkpoint, kept beside it.

    Micro-batches are numbered from 0 under each checkpoint, so sink folders
    carry this name too: a new checkpoint never overwrites older batches.
    """
    path = f"{checkpoint_root}/sink-run"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    name = uuid.uuid4().hex[:12]
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.text(path)
    return name


def start_payments_job(raw: DataFrame, bronze_path: str, stats_path: str, dlq_path: str,
                       checkpoint_root: str, dedup: str = "exact", stats_dedup: bool = False,
                       trigger: dict | None = None, dq_path: str | None = None,
                       sinks: tuple[str, ...] = ("bronze", "stats", "rules")):
    """The sinks of the payments job, each with its own checkpoint.

    ``sinks``: those to start; ``"dlq"`` writes dead letters without Bronze,
    ``"rules"`` needs ``dq_path``.

    Bronze goes through ``foreachBatch`` so that good rows and dead letters are
    written together (L1).  The PAY rules (L13) run on the events as they
    arrive, copies included, in a query of their own.  Returns the
    StreamingQuery handles: Bronze, statistics and, with ``dq_path``, rules.
    """
    trig = trigger or {"processingTime": "60 seconds"}
    run = sink_run(raw.sparkSession, checkpoint_root)
    parsed = parse_events(raw)
    good = good_events(parsed)
    deduped = deduplicate(good, dedup)

    def folder(root: str, batch_id: int) -> str:
        # A batch replayed after a failure overwrites its own folder instead of adding a second copy.
        return f"{root}/run={run}/batch_id={batch_id}"

    def write_bronze(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        by_institution(bronze_events(good_events(batch))).write.mode("overwrite") \
            .partitionBy("institution_id").parquet(folder(bronze_path, batch_id))
        dead_letters(batch).write.mode("overwrite").parquet(folder(dlq_path, batch_id))
        batch.unpersist()

    def write_rules(batch: DataFrame, batch_id: int) -> None:
        evaluate_event_rules(batch.drop("ts"), batch_id).write.mode("overwrite").parquet(folder(dq_path, batch_id))

    def start(df: DataFrame, name: str, write) -> StreamingQuery:
        return (df.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint_root}/{name}")
                .trigger(**trig).start())

    # dedup runs in the streaming plan (stateful); malformed rows bypass it.
    none = F.lit(None).cast("string")
    to_bronze = deduped.withColumns({"parse_error": F.lit(False), "error": none}).unionByName(
        parsed.where(F.col("parse_error")))
    queries = []
    if "bronze" in sinks:
        queries.append(start(to_bronze, "bronze", write_bronze))
    elif "dlq" in sinks:
        queries.append(start(parsed.where(F.col("parse_error")), "dlq", lambda batch, batch_id: dead_letters(batch).write.mode("overwrite")
                             .parquet(folder(dlq_path, batch_id))))
    if "stats" in sinks:
        stats_in = deduped if stats_dedup else good
        queries.append(minute_stats(stats_in).writeStream.format("parquet").outputMode("append")
                       .option("path", stats_path).option("checkpointLocation", f"{checkpoint_root}/stats")
                       .trigger(**trig).start())
    if dq_path and "rules" in sinks:
        queries.append(start(good, "rules", write_rules))
    return tuple(queries)
