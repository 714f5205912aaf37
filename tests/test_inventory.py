"""Remaining inventory items: DDL + INSERT (A9, A13), receipts (B7), FAILFAST (I9),
Gold freshness (L7), lifecycle stream (L14)."""
import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lakepipe.operators import governance, intake, ledger
from lakepipe.schemas import SUBMISSION_EVENT
from lakepipe.sources import tables
from lakepipe.streaming import payments


def test_create_table_if_not_exists_and_insert_values(spark):
    root = tempfile.mkdtemp(prefix="lakepipe-ddl-")
    schema = spark.createDataFrame([], "id int, message string").schema
    tables.ensure_table(spark, "smoke.hello", schema, os.path.join(root, "hello"))
    tables.ensure_table(spark, "smoke.hello", schema, os.path.join(root, "hello"))   # idempotent
    tables.insert_values(spark, "smoke.hello", [(1, "hello"), (2, "it's me")])
    got = sorted(tuple(r) for r in spark.table("smoke.hello").collect())
    assert got == [(1, "hello"), (2, "it's me")]


def test_receipts_for_received_files(spark):
    files = spark.createDataFrame(
        [("p/1", "FI001_LCR_2024-01_v1.csv", "abc", dt.datetime(2024, 1, 2, 3, 4, 5), ("abc",))],
        "path string, file_name string, sha256 string, received_at timestamp_ntz, manifest struct<sha256 string>")
    r = intake.receipts(intake.decide(files)).collect()[0]
    body = json.loads(r.receipt)
    assert body == {"submission_id": "FI001-LCR-2024-01-v1", "status": "RECEIVED",
                    "raw_uri": "p/1", "sha256": "abc",
                    "received_at": "2024-01-02 03:04:05"}


def test_failfast_parsing_stops_on_malformed_json(spark):
    raw = spark.createDataFrame([('{"event_id": "a", "event_time": 1}',), ("{broken",)], "value string")
    with pytest.raises(Exception):
        payments.parse_events(raw, on_error="fail").collect()
    ok = payments.parse_events(raw)                       # default: dead-letter routing
    assert payments.dead_letters(ok).count() == 1 and payments.good_events(ok).count() == 1


def test_gold_freshness_within_sla(spark):
    gold = spark.createDataFrame([("a,b", dt.datetime(2024, 1, 1, 5))], "submission_ids string, gold_built_at timestamp_ntz")
    acc = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 2)), ("b", dt.datetime(2023, 12, 31, 23))],
                                "submission_id string, accepted_at timestamp_ntz")
    got = {r.submission_id: (r.hours_to_gold, r.within_sla) for r in governance.gold_freshness(gold, acc, 4).collect()}
    assert got == {"a": (3.0, True), "b": (6.0, False)}


def test_lifecycle_stream(spark):
    root = tempfile.mkdtemp(prefix="lakepipe-life-")
    src = os.path.join(root, "events")
    ev = spark.createDataFrame([(1, "s1", "RECEIVED", "{}", dt.datetime(2024, 1, 1))], SUBMISSION_EVENT)
    ev.write.parquet(src)
    stream = spark.readStream.schema(SUBMISSION_EVENT).parquet(src)
    q = ledger.publish_lifecycle(stream, os.path.join(root, "out"), os.path.join(root, "ck"),
                                 trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.json(os.path.join(root, "out")).collect()
    assert len(out) == 1 and json.loads(out[0].value)["status"] == "RECEIVED"


def test_sizing_conf_scales_with_input():
    from lakepipe.session import sizing_conf
    small = sizing_conf(10 << 30, 8)
    big = sizing_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
    # every map task reports a size for each shuffle partition, so their number is bounded and splits grow
    assert int(big["spark.sql.shuffle.partitions"]) == 32768
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 << 20


def test_partitioned_write_rebalances_a_hot_partition(spark):
    """One partition value with most rows is split over several write tasks, not one."""
    root = tempfile.mkdtemp(prefix="lakepipe-hot-")
    df = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.lit("2024-02")).otherwise(F.lit("2024-01"))
                                     .alias("reporting_period"), "id").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        tables.create_or_replace(df, os.path.join(root, "t"), ["reporting_period"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(os.path.join(root, "t", "reporting_period=2024-01")) if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(os.path.join(root, "t")).count() == 200_000


def test_affected_periods_include_those_of_earlier_rows(spark):
    from lakepipe.operators import bronze
    from lakepipe.schemas import BRONZE_LCR
    path = tempfile.mkdtemp(prefix="lakepipe-periods-")

    def load(rows, batch=None):
        made = [("FI001", p, "HQLA_L1", "MYR", None, s, 1, "u", "h", dt.datetime(2024, 1, 1)) for p, s in rows]
        ids = None if batch is None else spark.createDataFrame([(s,) for s in batch], "submission_id string")
        return bronze.replace_submissions(spark, path, spark.createDataFrame(made, BRONZE_LCR), ids)
    assert load([("2024-01", "s1"), ("2024-03", "s2"), ("2024-04", "s3")]) == ["2024-01", "2024-03", "2024-04"]
    assert load([("2024-02", "s1")]) == ["2024-01", "2024-02"]
    assert load([("2024-02", "s1")], ["s1", "s3"]) == ["2024-01", "2024-02", "2024-04"]


def test_as_of_by_load_time_and_version(spark):
    rows = [("s-v1", 1, dt.datetime(2024, 2, 1)), ("s-v2", 2, dt.datetime(2024, 3, 1)), ("s-v3", 3, dt.datetime(2024, 4, 1))]
    b = spark.createDataFrame(rows, "submission_id string, submission_version int, loaded_at timestamp_ntz")
    assert sorted(r.submission_id for r in tables.as_of(b, loaded_before="2024-03-01 00:00:00").collect()) == ["s-v1", "s-v2"]
    assert sorted(r.submission_id for r in tables.as_of(b, max_version=1).collect()) == ["s-v1"]
