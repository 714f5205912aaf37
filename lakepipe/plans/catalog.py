"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the engine's operators over relations derived from the test tables
(``lakepipe.sources.testdata``).  Build timestamps are left out so that the
results are comparable with the oracle SQL in ``lakepipe.plans.oracle``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.contracts import load_rules
from lakepipe.operators import checks, gold, quality, silver
from lakepipe.session import ensure_checkpoint_dir
from lakepipe.sources import reference, tables
from lakepipe.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN1 = "2024-01-01 06:00:00"
RUN2 = "2024-02-01 06:00:00"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ---------------------------------------------------------------- LCR chain

def lcr_chain(spark: SparkSession, sf_dir: str, max_version: int | None = None,
              quarantine: str = "sticky", grain: str = "line", bronze_path: str | None = None):
    """Bronze -> rules -> Silver -> Gold over the derived returns (N_GOLD institutions)."""
    # Bronze is a table: materialise the derived one once under the checkpoint
    # folder, so rules, Silver and lineage scan it instead of re-deriving it.
    if bronze_path:
        tables.create_or_replace(td.lcr_bronze(spark, sf_dir, td.N_GOLD), bronze_path)
        bronze = spark.read.parquet(bronze_path)
    else:
        bronze = tables.stage(spark, td.lcr_bronze(spark, sf_dir, td.N_GOLD), "lcr-bronze")
    if max_version is not None:          # as-of read (A14 / L11)
        bronze = tables.as_of(bronze, max_version=max_version)
    dq = quality.evaluate(bronze, load_rules("lcr-monthly"), "bronze", checked_at=_ts(RUN1))
    slv = silver.build_silver(bronze, dq, quarantine=quarantine, grain=grain, build_ts=False)
    gld = gold.build_gold(slv, reference.line_codes(spark), td.institutions(spark, sf_dir, td.N_GOLD),
                          build_ts=False, codes_rows=reference.code_list_rows("lcr_line_codes"))
    return bronze, dq, slv, gld


@query
def lcr_gold_ratio(spark, sf_dir):
    return lcr_chain(spark, sf_dir)[3]


@query
def gold_by_change(spark, sf_dir):
    """Gold of the versions up to 300, brought up to date by the lines that the later ones bring and replace."""
    from lakepipe.operators import gold_changes
    codes, n = reference.line_codes(spark), reference.code_list_rows("lcr_line_codes")
    before = lcr_chain(spark, sf_dir, max_version=300)[2]
    bronze, _, after, _ = lcr_chain(spark, sf_dir)
    state = tables.stage(spark, gold_changes.contributions(before, codes, n), "gold-state")
    changes = gold_changes.line_changes(before, after, bronze.where(F.col("submission_version") > 300))
    return gold_changes.gold_of(gold_changes.apply_changes(state, changes, codes, n), td.institutions(spark, sf_dir, td.N_GOLD))


@query
def lcr_silver_current(spark, sf_dir):
    return lcr_chain(spark, sf_dir)[2]


@query
def lcr_silver_by_submission(spark, sf_dir):
    return lcr_chain(spark, sf_dir, grain="submission")[2]


@query
def lcr_gold_asof(spark, sf_dir):
    return lcr_chain(spark, sf_dir, max_version=300)[3]


# ------------------------------------------------------------ rules engine

RESULT_COLS = ["rule_id", "submission_id", "severity", "records_tested", "records_failed", "outcome"]


def _base(spark, sf_dir):
    """lineitem join orders, staged once for queries that derive several variants from it."""
    return tables.stage(spark, td.lineitem_orders(spark, sf_dir), "lineitem-orders")


def _rules_run(spark, sf_dir, *rule_ids, faults=True, checked_at=RUN1, base=None):
    rows = td.lcr_rules_input(spark, sf_dir, base=base, faults=faults)
    rules = load_rules("lcr-monthly")
    if rule_ids:
        rules = rules.only(*rule_ids)
    if base is None and any(r.type == "unique" for r in rules.for_stage("bronze").rules):
        # two aggregates read the input: stage the derived Bronze rows once
        rows = tables.stage(spark, rows, "rules-input")
    return quality.evaluate(rows, rules, "bronze", checked_at=_ts(checked_at))


def dq_history(spark, sf_dir, base=None):
    """Two runs of the Bronze rules: faulty delivery first, corrected re-run later."""
    base = base if base is not None else _base(spark, sf_dir)
    return _rules_run(spark, sf_dir, base=base).unionByName(
        _rules_run(spark, sf_dir, faults=False, checked_at=RUN2, base=base))


@query
def dq_not_null(spark, sf_dir):
    return _rules_run(spark, sf_dir, "LCR-001").select(*RESULT_COLS)


@query
def dq_accepted_values(spark, sf_dir):
    return _rules_run(spark, sf_dir, "LCR-002", "LCR-003").select(*RESULT_COLS)


@query
def dq_range(spark, sf_dir):
    return _rules_run(spark, sf_dir, "LCR-004").select(*RESULT_COLS)


@query
def dq_unique(spark, sf_dir):
    return _rules_run(spark, sf_dir, "LCR-005").select(*RESULT_COLS)


@query
def dq_aggregate_expr(spark, sf_dir):
    return _rules_run(spark, sf_dir, "LCR-006").select(*RESULT_COLS)


@query
def dq_row_expr(spark, sf_dir):
    """LCR-101 (row expression, warning) on Gold, per institution."""
    gld = lcr_chain(spark, sf_dir)[3]
    rules = load_rules("lcr-monthly").only("LCR-101")
    res = quality.evaluate(gld, rules, "gold", key="institution_id", checked_at=_ts(RUN1))
    return res.select("rule_id", F.col("submission_id").alias("institution_id"), "severity",
                      "records_tested", "records_failed", "outcome")


@query
def dq_all_rules_by_submission(spark, sf_dir):
    return _rules_run(spark, sf_dir).select(*RESULT_COLS)


@query
def dq_gate_status(spark, sf_dir):
    return quality.gate(_rules_run(spark, sf_dir))


@query
def dq_failures_by_rule(spark, sf_dir):
    return quality.failures_by_rule(dq_history(spark, sf_dir))


def _clean_bronze(spark, sf_dir, base=None):
    return td.lcr_rules_input(spark, sf_dir, base=base, faults=False)


def _quarantine(spark, sf_dir, mode):
    base = _base(spark, sf_dir)                     # both variants below are projections of it
    q = silver.quarantined_submissions(dq_history(spark, sf_dir, base), mode)
    return silver.remove_quarantined(_clean_bronze(spark, sf_dir, base), q)


@query
def quarantine_antijoin(spark, sf_dir):
    return _quarantine(spark, sf_dir, "sticky")


@query
def quarantine_latest_run(spark, sf_dir):
    return _quarantine(spark, sf_dir, "latest_run")


# ---------------------------------------------------------- model tests (H)

@query
def checks_not_null(spark, sf_dir):
    _, _, slv, gld = lcr_chain(spark, sf_dir)
    codes = tuple(td.LINE_CODES)
    s = checks.run_model_tests(slv, checks.silver_tests(codes), "silver", _ts(RUN1))
    g = checks.run_model_tests(gld, checks.gold_tests(), "gold", _ts(RUN1))
    return s.unionByName(g).select("rule_id", "stage", "severity", "records_tested",
                                   "records_failed", "outcome")


@query
def checks_one_current_version(spark, sf_dir):
    slv = silver.build_silver(_clean_bronze(spark, sf_dir), build_ts=False)
    dup = checks.one_current_version(slv)
    return dup.agg(F.count(F.lit(1)).alias("failing_groups"),
                   F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failing_rows"))


@query
def checks_ratio_plausible(spark, sf_dir):
    return checks.implausible_ratios(lcr_chain(spark, sf_dir)[3])


# ------------------------------------------------- structural validation (C)

def _validated_orders(spark, sf_dir):
    from lakepipe.contracts import load_contract
    from lakepipe.operators import structure
    return structure.validate(td.order_files(spark, sf_dir), load_contract())


@query
def structural_errors(spark, sf_dir):
    from lakepipe.operators import structure
    return structure.error_rows(_validated_orders(spark, sf_dir))


@query
def structural_counts(spark, sf_dir):
    return _validated_orders(spark, sf_dir).select(
        "submission_id", "status", "n_errors", "record_count", "reason")


@query
def control_total_check(spark, sf_dir):
    v = _validated_orders(spark, sf_dir)
    m = F.col("manifest")
    return v.select("submission_id", "record_count",
                    m["record_count"].alias("manifest_record_count"),
                    F.round("control_total", 2).cast("decimal(38,2)").alias("control_total"),
                    m["control_total"].alias("manifest_control_total"),
                    (F.col("record_count") == m["record_count"]).alias("count_ok"),
                    (F.abs(F.round("control_total", 2).cast("double") - m["control_total"]) <= 0.01)
                    .alias("total_ok"))


# ----------------------------------------------------------- intake (B)

@query
def intake_name_parse(spark, sf_dir):
    from lakepipe.operators import intake
    f = intake.parse_names(td.landing_files(spark, sf_dir))
    return f.select("path", "file_name", "name_ok", "institution_id", "return_type",
                    "reporting_period", "version", "submission_id", "raw_key")


@query
def intake_checksum(spark, sf_dir):
    from lakepipe.operators import intake
    f = intake.checksums(td.landing_files(spark, sf_dir))
    return f.select("path", "sha256", "manifest_ok", "manifest_sha256", "checksum_ok")


def _landing(spark, sf_dir):
    """The landing zone listing with checksums, staged once (texts hashed once)."""
    return tables.stage(spark, td.landing_files(spark, sf_dir).drop("content"), "landing")


@query
def intake_duplicate(spark, sf_dir):
    from lakepipe.operators import intake
    d = intake.decide(_landing(spark, sf_dir))
    return d.where(F.col("verdict") == "DUPLICATE").select("path", "sha256", "duplicate_of_file")


@query
def intake_verdict(spark, sf_dir):
    from lakepipe.operators import intake
    d = intake.decide(_landing(spark, sf_dir))
    return d.select("path", "submission_id", "verdict", "reason")


@query
def intake_receipts(spark, sf_dir):
    from lakepipe.operators import intake
    return intake.receipts(intake.decide(_landing(spark, sf_dir)))


# ------------------------------------------------------------ ledger (E)

def ledger_events(spark, sf_dir):
    """Lifecycle events of the rule-test submissions: received, gate verdict, publish."""
    from lakepipe.operators import ledger
    rows = tables.stage(spark, td.lcr_rules_input(spark, sf_dir), "rules-input")   # read twice below
    subs = rows.groupBy("submission_id").agg(F.min("loaded_at").alias("loaded_at"))
    received = ledger.status_events(subs, "RECEIVED",
                                    F.timestamp_add("HOUR", F.lit(-1), F.col("loaded_at")))
    results = quality.evaluate(rows, load_rules("lcr-monthly"), "bronze", checked_at=_ts(RUN1))
    verdict = quality.gate(results).join(subs, "submission_id")
    gated = ledger.status_events(
        verdict, F.col("status"), F.timestamp_add("HOUR", F.lit(1), F.col("loaded_at")),
        reason=F.when(F.col("status") == "QUARANTINED", F.lit("blocking quality rule failed")))
    published = ledger.status_events(verdict.where(F.col("status") == "ACCEPTED"), "PUBLISHED",
                                     F.timestamp_add("HOUR", F.lit(2), F.col("loaded_at")))
    return received.unionByName(gated).unionByName(published)


@query
def ledger_current_status(spark, sf_dir):
    from lakepipe.operators import ledger
    return ledger.current_status(ledger_events(spark, sf_dir)).select(
        "submission_id", "status", "status_reason", "received_at", "updated_at", "n_events")


@query
def ledger_time_in_status(spark, sf_dir):
    from lakepipe.operators import ledger
    return ledger.time_in_status(ledger_events(spark, sf_dir)).select(
        "submission_id", "status", "created_at", "left_at", "seconds_in_status")


# -------------------------------------------------------- Bronze replace

@query
def bronze_replay_replace(spark, sf_dir):
    """Clean Bronze, then every version-3 submission re-delivered (with faults)."""
    from lakepipe.operators import bronze
    li = _base(spark, sf_dir)
    base = _clean_bronze(spark, sf_dir, li)
    replay = td.lcr_rules_input(spark, sf_dir, base=li).where(F.col("submission_version") == 3)
    return bronze.replace_rows(base, replay)


@query
def bronze_moved_emptied(spark, sf_dir):
    """The Bronze sink after a re-delivery that moves submissions to another year and empties others."""
    from lakepipe.operators import bronze
    return bronze.current(_redelivered(spark, sf_dir))


REDELIVERED_AT = "2010-01-01 06:00:00"


def _redelivered(spark, sf_dir):
    """Bronze with its history: loaded, then moved submissions delivered again a year on and others delivered empty."""
    from lakepipe.operators import bronze
    from lakepipe.schemas import BRONZE_HISTORY
    from lakepipe.session import scratch_path
    from lakepipe.sources.versioned import Store
    path = scratch_path(spark, "bronze")
    bronze.replace_submissions(spark, path, td.rules_rows(spark, sf_dir, faults=False), at=_ts("2000-01-01 06:00:00"), derive=td.with_audit)
    base = bronze.current(Store(spark, path).read("bronze", BRONZE_HISTORY))       # the first delivery
    year = F.substring("reporting_period", 1, 4).cast("int") + 1
    moved = base.where(F.col("submission_version") == 3).withColumn(
        "reporting_period", F.concat(year.cast("string"), F.substring("reporting_period", 5, 3)))
    emptied = base.where((F.col("submission_version") == 2) & F.col("institution_id").endswith("7"))
    # rows of a period move together, so they are as clustered as Bronze is
    bronze.replace_submissions(spark, path, moved, moved.select("submission_id").union(emptied.select("submission_id")),
                               at=_ts(REDELIVERED_AT), clustered=True)
    return Store(spark, path).read("bronze", BRONZE_HISTORY)


@query
def bronze_asof_redelivery(spark, sf_dir):
    """Bronze as of a second before the re-delivery, by period: the moved and the emptied submissions are where they were.

    Moved rows carry their first load time, so the second delivery is told by the closing of the first.
    """
    history = _redelivered(spark, sf_dir).where(F.col("replaced_at").isNotNull())
    was = tables.as_of(history, loaded_before="2010-01-01 05:59:59")
    return was.groupBy("reporting_period", "submission_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("submission_id").alias("submissions"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


# ------------------------------------------------------- the flow, taken up

def _taken_up(spark, sf_dir):
    """The batch flow over the derived returns: a run that stops after validation, then one that gets the rest."""
    from lakepipe.plans.lcr_flow import Flow
    from lakepipe.session import scratch_path
    root = scratch_path(spark, "flow")
    files = tables.stage(spark, td.return_files(spark, sf_dir), "return-files")
    first = F.col("__version") % 2 == 0
    stopped = Flow(spark, root, now=_ts(RUN1))
    stopped.receive(files.where(first).drop("__version"))
    stopped.validate()
    later = Flow(spark, root, now=_ts(RUN2))
    later.receive(files.where(~first).drop("__version"))
    out = later.process(td.institutions(spark, sf_dir, td.N_GOLD))
    tables.discard(files)
    return out


@query
def flow_taken_up_status(spark, sf_dir):
    """Where every submission ended, those of the stopped run included."""
    return _taken_up(spark, sf_dir)["status"].select("submission_id", "status", "n_events")


@query
def flow_taken_up_gold(spark, sf_dir):
    return _taken_up(spark, sf_dir)["gold"].select("institution_id", "reporting_period", "hqla", "net_outflows", "lcr_ratio", "submission_ids")


# ----------------------------------------------------------- table sinks

@query
def dq_results_by_day(spark, sf_dir):
    """Two runs appended to the results table, partitioned by day, and read back."""
    from lakepipe.session import scratch_path
    path, base = scratch_path(spark, "dq-results"), _base(spark, sf_dir)
    for faults, run in ((True, RUN1), (False, RUN2)):
        results = _rules_run(spark, sf_dir, base=base, faults=faults, checked_at=run)
        tables.append(results.withColumn("checked_day", F.to_date("checked_at")), path, ["checked_day"])
    return spark.read.parquet(path).groupBy("checked_day", "rule_id", "outcome").agg(F.count(F.lit(1)).alias("results"))


@query
def orders_evolving(spark, sf_dir):
    """A table whose later files have one more column; the older rows read NULL there."""
    from lakepipe.operators import governance
    from lakepipe.session import scratch_path
    path, orders = scratch_path(spark, "evolving"), td.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    old = F.col("o_orderkey") % 2 == 0
    tables.append(orders.where(old).drop("o_totalprice"), path)
    tables.append(orders.where(~old), path)
    return governance.read_evolving(spark, path).select("o_orderkey", "o_orderdate", "o_totalprice")


# ---------------------------------------------------------- payments stream (I)

EVENT_COLS = ["event_id", "institution_id", "event_ts", "payment_system", "direction", "amount",
              "currency", "status"]


def _parsed_events(spark, sf_dir):
    from lakepipe.streaming import payments
    return payments.parse_events(td.payment_events_raw(spark, sf_dir))


@query
def events_dedup(spark, sf_dir):
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    return payments.bronze_events(payments.deduplicate(good, "exact")).select(*EVENT_COLS)


@query
def minute_stats(spark, sf_dir):
    """As the reference job runs it: windows over the raw (not deduplicated) events."""
    from lakepipe.streaming import payments
    return payments.minute_stats(payments.good_events(_parsed_events(spark, sf_dir)))


@query
def minute_stats_dedup(spark, sf_dir):
    """As documented: windows over deduplicated events."""
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    return payments.minute_stats(payments.deduplicate(good, "exact"))


@query
def minute_stats_late(spark, sf_dir):
    """Per window: events accepted, accepted-but-late, and dropped (> 5 min after event time).

    Lateness of an event = its arrival (ingest) time minus its event time, the
    contract's definition; the streaming watermark approximates it with the
    maximum event time seen.
    """
    from lakepipe.functions.columns import ntz_to_epoch_millis
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    late_ms = ntz_to_epoch_millis(F.col("arrival")) - F.col("event_time")
    g = (good.withColumn("late_ms", late_ms)
         .groupBy(F.window("ts", payments.WINDOW), "institution_id", "payment_system")
         .agg(F.count_if(F.col("late_ms") <= 300000).alias("event_count"),
              F.count_if((F.col("late_ms") > 0) & (F.col("late_ms") <= 300000)).alias("late_count"),
              F.count_if(F.col("late_ms") > 300000).alias("dropped_count")))
    return g.select(payments._wall_clock(F.col("window.start")).alias("window_start"),
                    "institution_id", "payment_system", "event_count", "late_count", "dropped_count")


STREAM_BATCHES, FILES_PER_BATCH = 2, 4


def _topic(spark, sf_dir, batch):
    """The derived topic (value, arrival), staged, each row with the number of its micro-batch."""
    events = tables.stage(spark, td.payment_events_raw(spark, sf_dir).select("value", "arrival"), "topic")
    ends = events.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi")).first()
    # as text: wall-clock times, whatever the zones of the session and of Python
    return events.withColumn("batch", batch(_ts(str(ends["lo"])), _ts(str(ends["hi"]))) if ends["lo"] is not None else F.lit(0))


def _by_arrival(n):
    """Batches of equal spans of arrival time, in whole milliseconds."""
    from lakepipe.functions.columns import ntz_to_epoch_millis as ms
    return lambda lo, hi: F.least(F.lit(n - 1), F.floor(
        (ms(F.col("arrival")) - ms(lo)) * n / F.greatest(ms(hi) - ms(lo), F.lit(1)))).cast("int")


def run_payments_stream(spark, sf_dir, sinks):
    """Replay the derived topic through the streaming job (availableNow), with the sinks that a query reads.

    The events arrive in STREAM_BATCHES micro-batches, by arrival time, so
    copies and late events meet state of earlier batches; a far-future sentinel
    then closes all windows.  Outputs live under the session's checkpoint
    folder.  Each stream query runs its own replay, so its timing includes the
    stream.
    """
    from lakepipe.session import scratch_path
    from lakepipe.streaming import payments
    base, topic = scratch_path(spark, "payments"), _topic(spark, sf_dir, _by_arrival(STREAM_BATCHES))
    for k in range(STREAM_BATCHES):
        topic.where(F.col("batch") == k).select("value").repartition(FILES_PER_BATCH).write.mode("append").text(f"{base}/src")
    td.sentinel_event(spark).write.mode("append").text(f"{base}/src")
    raw = payments.read_source(spark, "text", f"{base}/src", max_files_per_trigger=FILES_PER_BATCH)
    qs = payments.start_payments_job(raw, f"{base}/bronze", f"{base}/stats", f"{base}/dlq",
                                     f"{base}/checkpoints", trigger={"availableNow": True},
                                     dq_path=f"{base}/dq", sinks=sinks)
    for q in qs:
        q.awaitTermination()
    return base


LATE_BATCHES = 4


def run_late_stream(spark, sf_dir, **sinks):
    """Replay in LATE_BATCHES spans; events that are 7 minutes late come one batch later still, so windows refuse some."""
    from lakepipe.session import scratch_path
    from lakepipe.streaming import late, payments

    def batch(lo, hi):
        delayed = F.coalesce(F.get_json_object("value", "$.event_id").cast("long") % 170 == 0, F.lit(False))
        return _by_arrival(LATE_BATCHES)(lo, hi) + delayed.cast("int")
    base, topic = scratch_path(spark, "payments"), _topic(spark, sf_dir, batch)
    for k in range(LATE_BATCHES + 2):
        part = topic.where(F.col("batch") == k).select("value") if k <= LATE_BATCHES else td.sentinel_event(spark)
        part.write.mode("append").text(f"{base}/src")
        raw = payments.read_source(spark, "text", f"{base}/src")          # what is new is one micro-batch
        for q in late.start_table_sinks(raw, f"{base}/checkpoints", trigger={"availableNow": True}, **{x: f"{base}/{v}" for x, v in sinks.items()}):
            q.awaitTermination()
    return base


@query
def stream_late_events(spark, sf_dir):
    """Windows and the events that they refused, by window: together they are all events."""
    base = run_late_stream(spark, sf_dir, stats_path="stats", late_path="late")
    keys = ["window_start", "institution_id", "payment_system"]
    windows = spark.read.parquet(f"{base}/stats").groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
    from lakepipe.functions.columns import epoch_millis_to_ntz
    start = epoch_millis_to_ntz(F.floor(F.col("event_time") / 60000) * 60000)
    refused = spark.read.parquet(f"{base}/late").withColumn("window_start", start).groupBy(*keys).agg(F.count(F.lit(1)).alias("late_count"))
    both = windows.join(refused, keys, "full").where(F.col("institution_id") != td.SENTINEL_INST)
    return both.select(*keys, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("event_count", "late_count")])


@query
def stream_dedup_bounded(spark, sf_dir):
    """L2: the events that the dedup with a 10-minute horizon keeps, late ones included."""
    base = run_late_stream(spark, sf_dir, dedup_path="events")
    kept = spark.read.parquet(f"{base}/events").where(F.col("institution_id") != td.SENTINEL_INST)
    return kept.select(*EVENT_COLS)


@query
def stream_rules(spark, sf_dir):
    """The results of the stream's own rules sink, summed over its micro-batches."""
    base = run_payments_stream(spark, sf_dir, ("rules",))
    return spark.read.parquet(f"{base}/dq").where(F.col("rule_id") != "PAY-003").groupBy("rule_id", "severity").agg(
        F.sum("records_tested").alias("records_tested"), F.sum("records_failed").alias("records_failed"))


@query
def stream_bronze_events(spark, sf_dir):
    base = run_payments_stream(spark, sf_dir, ("bronze",))
    b = spark.read.parquet(f"{base}/bronze")
    return b.where(F.col("institution_id") != td.SENTINEL_INST).select(*EVENT_COLS)


@query
def stream_bronze_compacted(spark, sf_dir):
    """The stream's events after its finished batches were merged by day and their folders deleted."""
    from lakepipe.streaming.compaction import BatchFolders
    base = run_payments_stream(spark, sf_dir, ("bronze",))
    folders = BatchFolders(spark, f"{base}/bronze", spark.read.parquet(f"{base}/bronze").drop("run", "batch_id").schema)
    folders.compact(F.date_format("event_ts", "yyyy-MM-dd"))
    folders.clean(folders.store.state())
    return folders.read().where(F.col("institution_id") != td.SENTINEL_INST).select(*EVENT_COLS)


@query
def stream_minute_stats(spark, sf_dir):
    base = run_payments_stream(spark, sf_dir, ("stats",))
    s = spark.read.parquet(f"{base}/stats")
    return s.where(F.col("institution_id") != td.SENTINEL_INST)


@query
def stream_dlq(spark, sf_dir):
    base = run_payments_stream(spark, sf_dir, ("dlq",))
    d = spark.read.parquet(f"{base}/dlq")
    return d.select(F.regexp_extract("value", r'"event_id":"([^"]*)"', 1).alias("source_event_id"), "error")


# ----------------------------------------------------------- serving (J)

def served_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Bronze and Gold as the flow leaves them: tables of this application, Gold partitioned by period.

    The first serving query builds them; the others read them, with partition
    pruning.  Tables whose source files have changed since are built anew.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakepipe-served-{spark.sparkContext.applicationId}"
    sources = [tables.file_marks(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "supplier", "nation")]
    root += "-" + hashlib.sha256(repr((sf_dir, sources)).encode()).hexdigest()[:12]
    if not tables.exists(spark, f"{root}/complete"):
        gld = lcr_chain(spark, sf_dir, bronze_path=f"{root}/bronze")[3]
        tables.create_or_replace(gld, f"{root}/gold", ["reporting_period"])
        tables.create_or_replace(spark.range(1), f"{root}/complete")       # written last
    gold_schema = spark.read.parquet(f"{root}/gold").schema
    fixed = T.StructType([T.StructField(f.name, T.StringType() if f.name == "reporting_period" else f.dataType)
                          for f in gold_schema.fields])
    return spark.read.parquet(f"{root}/bronze"), spark.read.schema(fixed).parquet(f"{root}/gold")


def _gold(spark, sf_dir):
    return served_tables(spark, sf_dir)[1]


@query
def serve_ratio_by_institution(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.ratio_by_institution(_gold(spark, sf_dir))


@query
def serve_ratio_trend(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.ratio_trend(_gold(spark, sf_dir))


@query
def serve_below_threshold(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.below_threshold(_gold(spark, sf_dir))


@query
def serve_point_lookup(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.point_lookup(_gold(spark, sf_dir), "FI001", "1993-01")


@query
def policy_mask(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.apply_policy(_gold(spark, sf_dir), "analyst")


@query
def policy_row_filter(spark, sf_dir):
    from lakepipe.operators import serving
    return serving.apply_policy(_gold(spark, sf_dir), "supervisor")


@query
def lineage_trace(spark, sf_dir):
    from lakepipe.operators import serving
    bronze, gld = served_tables(spark, sf_dir)
    return serving.lineage(gld, bronze)


@query
def mixed_batch_stream(spark, sf_dir):
    from lakepipe.operators import serving
    from lakepipe.streaming import payments
    stats = payments.minute_stats(payments.good_events(_parsed_events(spark, sf_dir)))
    return serving.mixed_batch_stream(_gold(spark, sf_dir), stats)


# ------------------------------------------------ contract capabilities (L)

@query
def codelist_violations(spark, sf_dir):
    from lakepipe.operators import governance
    codes = {"line_code": reference.codes("lcr_line_codes"), "currency": reference.codes("currencies")}
    return governance.codelist_violations(td.lcr_rules_input(spark, sf_dir), codes, {"amount": 0})


@query
def schema_row_check(spark, sf_dir):
    from lakepipe.contracts import load_contract
    from lakepipe.operators import governance, structure
    contract = load_contract()
    rows = structure.parse_records(td.order_files(spark, sf_dir), contract, keep=("submission_id",))
    enums = {"line_code": reference.codes("lcr_line_codes"), "currency": reference.codes("currencies")}
    return governance.schema_violations(rows, contract, enums)


@query
def deadline_timeliness(spark, sf_dir):
    from lakepipe.contracts import load_contract
    from lakepipe.operators import governance
    subs = (td.lcr_rules_input(spark, sf_dir)
            .groupBy("submission_id", "reporting_period").agg(F.min("loaded_at").alias("received_at")))
    return governance.timeliness(subs, load_contract().deadline_days)


@query
def freshness_p95(spark, sf_dir):
    """p95 of produce -> ingest latency per institution, whole seconds (exact)."""
    from lakepipe.functions.columns import ntz_to_epoch_millis
    from lakepipe.operators import governance
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    lat = good.select("institution_id", F.floor((ntz_to_epoch_millis(F.col("arrival")) - F.col("event_time"))
                                               / 1000).alias("latency_s"))
    return governance.exact_percentile(lat, "institution_id", "latency_s", 0.95)


#: What the rank of a sketched percentile may be off by; twice what sketches of this size promise.
RANK_ERROR = 0.02


@query
def freshness_sketch(spark, sf_dir):
    """p95 of the latency from mergeable sketches per minute, held against the ranks of all values."""
    from lakepipe.functions.columns import ntz_to_epoch_millis
    from lakepipe.operators import governance
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    latency = tables.stage(spark, good.select("institution_id", "arrival", (
        ntz_to_epoch_millis(F.col("arrival")) - F.col("event_time")).alias("latency_ms")), "latency")
    sketches = governance.latency_sketches(latency, "institution_id", "arrival", "latency_ms")
    p95 = governance.sketched_percentile(sketches, "institution_id", 0.95)
    return governance.rank_check(latency, p95, "institution_id", "latency_ms", 0.95, RANK_ERROR).select(
        "institution_id", "n", "within_bound")


RETENTION_AS_OF = "2006-01-01"


@query
def retention_candidates(spark, sf_dir):
    from lakepipe.contracts import load_contract
    from lakepipe.operators import governance
    bronze, _, slv, _ = lcr_chain(spark, sf_dir)
    years = {z: int(v.strip("PY")) for z, v in load_contract().retention.items()}
    return governance.retention_candidates(bronze, "bronze", years["bronze"], RETENTION_AS_OF).unionByName(
        governance.retention_candidates(slv, "silver", years["silver"], RETENTION_AS_OF))


#: Keys of the derived test tables, published here and in the oracle SQL; real ones come from the session.
TEST_KEYS = {1: b"published test key 1", 2: b"published test key 2"}


@query
def tokenise_ids(spark, sf_dir):
    """Silver with keyed tokens in place of the ids, also inside the submission ids."""
    from lakepipe.operators.tokens import Tokens
    return Tokens(spark, TEST_KEYS).replace(lcr_chain(spark, sf_dir)[2], ["institution_id"],
                                            derived={"submission_id": "institution_id"})


@query
def token_rotation(spark, sf_dir):
    """Silver under the first key brought to the second by the token table, and turned back by the new one."""
    from lakepipe.operators.tokens import Tokens, reveal, rotate
    slv = lcr_chain(spark, sf_dir)[2]
    old, new = Tokens(spark, {1: TEST_KEYS[1]}), Tokens(spark, TEST_KEYS)
    stored = tables.stage(spark, old.replace(slv, ["institution_id"]), "silver-tokens")
    known = old.table(slv, "institution_id")
    moved = rotate(stored, "institution_id", new.rotation(known))
    return reveal(moved, "institution_id", new.table(slv, "institution_id"), "raw_id").groupBy(
        F.col("institution_id").alias("token"), "raw_id").agg(F.count(F.lit(1)).alias("row_count"))


@query
def retention_archive(spark, sf_dir):
    """Bronze after its expired months went to the archive: rows and amounts by place and month."""
    import datetime as dt

    from lakepipe.contracts import load_contract
    from lakepipe.operators.archive import Retention
    from lakepipe.session import scratch_path
    from lakepipe.sources.versioned import Store
    bronze = td.lcr_bronze(spark, sf_dir, td.N_GOLD)
    live, kept = Store(spark, scratch_path(spark, "live")), Store(spark, scratch_path(spark, "archive"))
    live.commit({"bronze": live.written(bronze, "bronze", by_period=True)})
    years = int(load_contract().retention["bronze"].strip("PY"))
    Retention(live, kept, "bronze", bronze.schema).run(years, dt.date.fromisoformat(RETENTION_AS_OF), dt.datetime.fromisoformat(RUN2))
    places = [s.read("bronze", bronze.schema).withColumn("place", F.lit(n)) for s, n in ((live, "live"), (kept, "archive"))]
    return places[0].unionByName(places[1]).groupBy("place", "reporting_period").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


AS_OF_PERIOD = "2001-08"


@query
def expected_vs_received(spark, sf_dir):
    from lakepipe.operators import governance
    inst = td.institutions(spark, sf_dir, td.N_RULES)
    onboarding = inst.select("institution_id", F.date_format("active_from", "yyyy-MM").alias("first_period"))
    expected = governance.expected_returns(onboarding, AS_OF_PERIOD)
    return governance.missing_returns(expected, td.lcr_rules_input(spark, sf_dir))


@query
def bitemporal_reference(spark, sf_dir):
    from lakepipe.operators import governance
    facts = td.lcr_bronze(spark, sf_dir).select("institution_id", "reporting_period").distinct()
    return governance.as_of_reference(facts, td.institution_versions(spark, sf_dir, td.N_GOLD)).select(
        "institution_id", "reporting_period", "institution_name", "peer_group", "active_from")


@query
def event_rules(spark, sf_dir):
    """PAY-001..004 per daily batch of arrivals, before dedup (L13; PAY-003 sees the copies)."""
    from lakepipe.streaming import payments
    good = payments.good_events(_parsed_events(spark, sf_dir))
    res = payments.evaluate_event_rules(good.drop("ts"), F.date_format("arrival", "yyyy-MM-dd"))
    return res.select("rule_id", F.col("submission_id").alias("batch_id"), "severity",
                      "records_tested", "records_failed", "outcome")


@query
def event_enum_check(spark, sf_dir):
    """Avro enum conformance of the parsed events (L5): violations per field."""
    from lakepipe.streaming import payments
    bad = payments.enum_violations(payments.good_events(_parsed_events(spark, sf_dir)))
    return bad.agg(*[F.count_if(F.col(f"bad_{c}")).alias(f"bad_{c}")
                     for c in ("payment_system", "direction", "status")],
                   F.count(F.lit(1)).alias("bad_rows"))


@query
def ledger_oldest_received(spark, sf_dir):
    """The oldest RECEIVED event (ORDER BY ... LIMIT 1 as a top-k, ties by submission id)."""
    ev = ledger_events(spark, sf_dir).where(F.col("status") == "RECEIVED")
    return ev.orderBy("created_at", "submission_id").limit(1).select("submission_id", "created_at")
