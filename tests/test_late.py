"""Late events as data and duplicates with bounded state, batch by batch."""
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakepipe.schemas import PAYMENT_EVENT
from lakepipe.streaming import late

T0 = 1_704_067_200_000          # 2024-01-01 00:00:00 UTC in ms


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="lakepipe-late-")


def batch(spark, *events):
    made = [(e, "FI001", None if m is None else T0 + int(m * 60_000), "RTGS", "IN", 1.5, "MYR", "FAILED" if e == "f" else "SETTLED") for e, m in events]
    return spark.createDataFrame(made, PAYMENT_EVENT).withColumn("ts", F.timestamp_millis("event_time"))


def test_windows_and_late_events_are_all_events(spark, folder):
    state = late.BatchState(spark, f"{folder}/state")
    run = lambda i, *e: late.window_batch(state, batch(spark, *e), i, f"{folder}/stats", f"{folder}/late")
    run(0, ("a", 0.1), ("f", 0.2), ("b", 10.0))
    run(1, ("c", 0.5), ("d", 4.5), ("e", 5.2))               # watermark 5:00: windows 0 and 4 are closed, 5 is not
    run(1, ("c", 0.5), ("d", 4.5), ("e", 5.2))               # a batch that is replayed
    run(2)
    run(3, ("g", 9.9), ("h", 60.0))
    run(4, ("z", 2000.0), ("y", 56.0))
    refused = spark.read.parquet(f"{folder}/late")
    assert rows(refused, "event_id", "late_ms") == [("c", 570_000), ("d", 330_000)]
    stats = spark.read.parquet(f"{folder}/stats").where("window_start < '2024-01-01 02:00'")
    assert {(r["window_start"].strftime("%H:%M"), r["event_count"], r["total_amount"], r["failed_count"]) for r in stats.collect()} == {
        ("00:00", 2, 3.0, 1), ("00:05", 1, 1.5, 0), ("00:09", 1, 1.5, 0), ("00:10", 1, 1.5, 0), ("00:56", 1, 1.5, 0), ("01:00", 1, 1.5, 0)}
    assert state.batches("open")[-1] == 4 and len(state.batches("open")) <= 3


def test_bounded_dedup_keeps_late_events_and_forgets_old_buckets(spark, folder):
    state = late.BatchState(spark, f"{folder}/state")
    run = lambda i, *e: late.dedup_batch(state, batch(spark, *e), i, f"{folder}/out")
    sizes = []
    for i in range(8):                                        # several horizons
        events = [(f"e{i}.{k}", 15.0 * i + k) for k in range(10)]
        run(i, *events, *events[:3], *([(f"e{i - 1}.9", 15.0 * (i - 1) + 9)] if i else []))
        if i == 4:
            run(i, *events, *events[:3], ("e3.9", 54.0))       # a batch that is replayed
        sizes.append(state.before("seen", i + 1, late.SEEN).count())
    run(8, ("late", 1.0), ("late", 1.0), (None, 106.0), ("no time", None))
    kept = [r["event_id"] for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(map(str, kept)) == sorted([f"e{i}.{k}" for i in range(8) for k in range(10)] + ["late", "None", "no time"])
    assert max(sizes) <= 30 and len(state.batches("seen")) <= 3        # state does not grow with the stream
