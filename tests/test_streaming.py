"""Payments stream on a JSON file source: micro-batch watermark boundaries, dedup, DLQ."""
import json
import os
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from lakepipe.streaming import payments

T0 = 1_704_067_200_000          # 2024-01-01 00:00:00 UTC in ms
MIN = 60_000


def ev(eid, minute, sec=10, status="SETTLED", amount=10.0):
    return {"event_id": eid, "institution_id": "FI001", "event_time": T0 + minute * MIN + sec * 1000,
            "payment_system": "RTGS", "direction": "OUT", "amount": amount, "currency": "MYR", "status": status}


def _write(folder, name, lines, mtime):
    p = os.path.join(folder, name)
    with open(p, "w") as fh:
        for line in lines:
            fh.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    os.utime(p, (mtime, mtime))


def _run(spark, files, dedup="exact"):
    root = tempfile.mkdtemp(prefix="lakepipe-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    for i, lines in enumerate(files):
        _write(src, f"part-{i:03d}.json", lines, 1_700_000_000 + 10 * i)
    raw = payments.read_source(spark, "text", src, max_files_per_trigger=1)
    qs = payments.start_payments_job(raw, f"{root}/bronze", f"{root}/stats", f"{root}/dlq", f"{root}/ck",
                                     dedup=dedup, trigger={"availableNow": True}, dq_path=f"{root}/dq")
    for q in qs:
        q.awaitTermination()
    _run.last = qs
    return root


def test_late_rows_dropped_by_windows_kept_by_bronze(spark):
    """Late rows are filtered with the PREVIOUS batch's watermark (micro-batch granular):
    D1 arrives one batch after the watermark passed its window and is still counted,
    D2 arrives a batch later and is dropped; Bronze keeps both."""
    root = _run(spark, [
        [ev("A", 0), ev("B", 1, status="FAILED"), "{not json"],
        [ev("C", 10)],                                   # watermark -> 00:05:10
        [ev("D1", 0, sec=30), ev("E", 6)],               # late, but filtered with the old watermark
        [ev("D2", 0, sec=50), ev("A", 0)],               # late and dropped; A re-sent
        [ev("Z", 60 * 24)],                              # closes every window
    ])
    stats = {(r.window_start.strftime("%H:%M"), r.event_count, r.failed_count)
             for r in spark.read.parquet(f"{root}/stats").where("window_start < '2024-01-01 01:00'").collect()}
    assert stats == {("00:00", 2, 0), ("00:01", 1, 1), ("00:06", 1, 0), ("00:10", 1, 0)}
    # D2 and the late copy of A share a window: one partial-aggregate row is dropped
    assert payments.rows_dropped_by_watermark(_run.last[1]) == 1
    bronze = sorted(r.event_id for r in spark.read.parquet(f"{root}/bronze").collect())
    assert bronze == ["A", "B", "C", "D1", "D2", "E", "Z"]   # late rows kept, duplicate A removed
    assert spark.read.parquet(f"{root}/dlq").count() == 1
    b = spark.read.parquet(f"{root}/bronze").where("event_id = 'A'").collect()[0]
    assert b.event_ts.isoformat() == "2024-01-01T00:00:10"


def test_batch_functions_match_stream_without_late_data(spark):
    evs = [ev("A", 0), ev("B", 0, sec=20, amount=2.5), ev("C", 1), ev("A", 0)]
    root = _run(spark, [evs, [ev("Z", 60 * 24)]])
    raw = spark.createDataFrame([(json.dumps(e),) for e in evs], "value string")
    batch = payments.minute_stats(payments.good_events(payments.parse_events(raw)))
    stream = spark.read.parquet(f"{root}/stats").where(F.col("institution_id") == "FI001") \
        .where("window_start < '2024-01-01 01:00'")
    key = lambda df: sorted((r.window_start, r.event_count, r.total_amount) for r in df.collect())
    assert key(batch) == key(stream)
    assert [r.event_count for r in batch.orderBy("window_start").collect()] == [3, 1]   # copies counted (as code)


def test_bounded_dedup_lets_far_apart_copies_through(spark):
    root = _run(spark, [[ev("A", 0)], [ev("C", 30)], [ev("A", 0)], [ev("Z", 60 * 24)]], dedup="bounded")
    ids = sorted(r.event_id for r in spark.read.parquet(f"{root}/bronze").collect())
    # the copy of A arrives after the 10-minute horizon: dropped as late by the
    # bounded dedup watermark, never duplicated
    assert ids.count("A") <= 1


def test_event_rules_per_batch(spark):
    root = _run(spark, [[ev("A", 0), ev("B", 0, amount=-1.0)], [ev("Z", 60 * 24)]])
    dq = spark.read.parquet(f"{root}/dq").where("rule_id = 'PAY-002' AND outcome = 'FAIL'").collect()
    assert len(dq) == 1 and dq[0].records_failed == 1


def _bronze_files(spark, tmp_path, events, n_files):
    """Files by micro-batch and institution of the Bronze sink over one micro-batch of several source files, and its ids."""
    src = tmp_path / "src"
    src.mkdir()
    for i in range(n_files):
        _write(str(src), f"part-{i:03d}.json", events[i::n_files], 1_700_000_000 + i)
    raw = payments.read_source(spark, "text", str(src))
    for q in payments.start_payments_job(raw, f"{tmp_path}/bronze", f"{tmp_path}/stats", f"{tmp_path}/dlq", f"{tmp_path}/ck",
                                         trigger={"availableNow": True}, sinks=("bronze",)):
        q.awaitTermination()
    files = Counter(p.parent.relative_to(tmp_path / "bronze").parts[1:] for p in (tmp_path / "bronze").rglob("*.parquet"))
    return files, [(r.event_id, r.institution_id) for r in spark.read.parquet(f"{tmp_path}/bronze").select("event_id", "institution_id").collect()]


def test_bronze_batch_has_one_file_per_institution(spark, tmp_path):
    """A stateful stream ignores the REBALANCE hint: every task wrote a file for every institution."""
    events = [ev(f"e{i}", 0) | {"institution_id": f"FI{i % 5:03d}" if i % 5 else None} for i in range(200)]
    files, kept = _bronze_files(spark, tmp_path, events, 4)
    assert len(files) == 5 and set(files.values()) == {1}
    assert Counter(kept) == Counter((e["event_id"], e["institution_id"]) for e in events)


def test_bronze_batch_splits_a_large_institution(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(payments, "ROWS_PER_TASK", 50)
    events = [ev(f"e{i}", 0) | {"institution_id": "FI001" if i < 190 else "FI002" if i < 195 else None} for i in range(260)]
    files, kept = _bronze_files(spark, tmp_path, events, 2)
    n = {part[1]: k for part, k in files.items()}
    assert n["institution_id=FI002"] == 1 and n["institution_id=FI001"] > 1
    assert Counter(kept) == Counter((e["event_id"], e["institution_id"]) for e in events)


def test_small_batch_is_dealt_to_a_task_a_core(spark):
    """However many shuffle partitions the state has; its institutions are not counted, as none can be large."""
    events = spark.range(200).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("FI00"), F.col("id") % 5)).alias("institution_id"))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        clustered = payments.by_institution(events)
        assert clustered.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert "Join" not in clustered._jdf.queryExecution().executedPlan().toString()
        where = clustered.select("institution_id", F.spark_partition_id().alias("task")).distinct().collect()
        assert len(where) == 5 and clustered.exceptAll(events).count() == 0 and clustered.count() == 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
