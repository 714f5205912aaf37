"""Unit tests of intake, structure, ledger, serving, governance, functions, tables."""
import datetime as dt
import os
import tempfile
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.contracts import load_contract
from lakepipe.functions.columns import epoch_millis_to_ntz, ntz_to_epoch_millis, strict_least
from lakepipe.operators import governance, intake, ledger, serving, structure
from lakepipe.sources import reference, tables
from conftest import rows

MAN = "record_count long, control_total double"
H = "institution_id,reporting_period,line_code,currency,amount"


def _validate(spark, content, record_count=1, total=1.0, manifest=True):
    df = spark.createDataFrame([("s", content, (record_count, total) if manifest else None)],
                               f"submission_id string, content string, manifest struct<{MAN}>")
    return structure.validate(df, load_contract()).collect()[0]


def test_structure_clean_file_with_trailing_newlines(spark):
    r = _validate(spark, f"{H}\nFI001,2024-01,HQLA_L1,MYR, 1.005 \n\n", 1, 1.01)
    assert r.status == "VALIDATED" and r.errors == [] and r.record_count == 1


def test_structure_messages_in_report_order(spark):
    content = ("reporting_period,institution_id,line_code,currency,amount\n"
               "2024/01,FI01,HQLA_L1,,x\n"
               "2024-01,FI001,HQLA_L1,MYR,1_000\n")
    r = _validate(spark, content, 3, 5.0)
    assert r.errors == [
        "header ['reporting_period', 'institution_id', 'line_code', 'currency', 'amount'] != contract "
        "['institution_id', 'reporting_period', 'line_code', 'currency', 'amount']",
        "line 2: institution_id='FI01' does not match ^FI[0-9]{3}$",
        "line 2: reporting_period='2024/01' does not match ^[0-9]{4}-[0-9]{2}$",
        "line 2: currency is required",
        "line 2: amount='x' is not a number",
        "line 3: amount='1_000' is not a number",
        "record count 2 != manifest 3",
        "control total 0.00 != manifest 5.00"]
    assert r.status == "REJECTED" and r.reason == "8 structural errors"


def test_structure_short_header_and_missing_manifest(spark):
    r = _validate(spark, "institution_id,reporting_period,line_code,currency\nFI001,2024-01,HQLA_L1,MYR,5\n",
                  manifest=False)
    assert r.errors[1:] == ["line 2: amount is required", "manifest missing"]


def test_structure_empty_file_and_blank_header(spark):
    assert _validate(spark, "", 0, 0.0).errors[0].startswith("header None != contract")
    r = _validate(spark, "\nFI001,2024-01,HQLA_L1,MYR,1\n", 1, 1.0)
    assert r.errors[0].startswith("header [] != contract") and r.record_count == 1


def test_parse_records_by_header_name(spark):
    df = spark.createDataFrame([("s", "k", "h", "amount,institution_id,reporting_period,line_code,currency\n"
                                 "1.005,FI001,2024-01,IN_TOTAL,MYR\n")],
                               "submission_id string, raw_key string, sha256 string, content string")
    r = structure.parse_records(df, load_contract()).collect()[0]
    assert (r.institution_id, r.line_code, r.amount, r.line_no) == ("FI001", "IN_TOTAL", Decimal("1.01"), 2)


def _files(spark, data):
    return spark.createDataFrame(
        [(p, n, sha, dt.datetime(2024, 1, 1, 0, i), (msha,) if msha else None)
         for i, (p, n, sha, msha) in enumerate(data)],
        "path string, file_name string, sha256 string, received_at timestamp_ntz, manifest struct<sha256 string>")


def test_intake_chain_with_earlier_ledger(spark):
    f = _files(spark, [("a/1", "FI001_LCR_2024-01_v1.csv", "s1", "s1"),
                       ("a/2", "FI001_LCR_2024-01_v1.csv", "s2", "s2"),     # same name, new content
                       ("a/3", "FI002_LCR_2024-01_v1.csv", "s1", "s1"),     # same content, other name
                       ("a/4", "FI003_LCR_2024-1_v1.csv", "s4", "s4"),      # bad name
                       ("a/5", "FI004_LCR_2024-01_v1.csv", "s5", None),     # no manifest
                       ("a/6", "FI005_LCR_2024-01_v1.csv", "s6", "zz"),     # checksum
                       ("a/7", "FI006_LCR_2024-01_v2.csv", "old", "old"),   # received in an earlier run
                       ("a/8", "FI007_LCR_2024-01_v1.csv", "s8", "s8")])    # name taken earlier
    led = spark.createDataFrame([("old", "FI009", "LCR", "2023-12", 1), ("x", "FI007", "LCR", "2024-01", 1)],
                                "sha256 string, institution_id string, return_type string, "
                                "reporting_period string, version int")
    got = dict(rows(intake.decide(f, led), "path", "verdict"))
    assert got == {"a/1": "RECEIVED", "a/2": "VERSION_CONFLICT", "a/3": "DUPLICATE", "a/4": "REJECTED",
                   "a/5": "REJECTED", "a/6": "REJECTED", "a/7": "DUPLICATE", "a/8": "VERSION_CONFLICT"}


def test_ledger_current_status_and_time_in_status(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame(
        [(1, "s1", "RECEIVED", "{}", t), (2, "s1", "VALIDATED", "{}", t + dt.timedelta(hours=1)),
         (3, "s1", "ACCEPTED", "{}", t + dt.timedelta(hours=2)), (4, "s1", "PUBLISHED", "{}", t + dt.timedelta(hours=2)),
         (5, "s2", "RECEIVED", "{}", t), (6, "s2", "REJECTED", '{"reason":"3 structural errors"}', t)],
        "event_id long, submission_id string, status string, detail string, created_at timestamp_ntz")
    cur = {r.submission_id: (r.status, r.status_reason, r.n_events) for r in ledger.current_status(ev).collect()}
    assert cur == {"s1": ("PUBLISHED", None, 4), "s2": ("REJECTED", "3 structural errors", 2)}
    tis = rows(ledger.time_in_status(ev).where("submission_id = 's1'"), "status", "seconds_in_status")
    assert ("RECEIVED", 3600) in tis and ("PUBLISHED", None) in tis and ("ACCEPTED", 0) in tis


def test_policies(spark):
    g = spark.createDataFrame([("FI001", "Bank 1", 1.5), ("FI003", "Bank 3", 0.9)],
                              "institution_id string, institution_name string, lcr_ratio double")
    assert rows(serving.apply_policy(g, "analyst"), "institution_name") == [("***",), ("***",)]
    assert rows(serving.apply_policy(g, "supervisor"), "institution_id") == [("FI001",)]
    assert serving.apply_policy(g, "platform-admin").count() == 2
    with pytest.raises(PermissionError):
        serving.apply_policy(g, "guest")


def test_exact_percentile_matches_numpy(spark):
    vals = [("a", int(v)) for v in np.random.default_rng(7).integers(0, 50, 501)] + [("b", 3), ("b", 10)]
    got = {r.g: r.p95 for r in governance.exact_percentile(
        spark.createDataFrame(vals, "g string, v long"), "g", "v", 0.95).collect()}
    assert got["a"] == pytest.approx(np.percentile([v for g, v in vals if g == "a"], 95))
    assert got["b"] == pytest.approx(9.65)


def test_expected_vs_received(spark):
    onb = spark.createDataFrame([("FI001", "2024-01"), ("FI002", "2024-05")], "institution_id string, first_period string")
    exp = governance.expected_returns(onb, "2024-03")
    rec = spark.createDataFrame([("FI001", "2024-02")], "institution_id string, reporting_period string")
    assert rows(governance.missing_returns(exp, rec)) == [("FI001", "2024-01"), ("FI001", "2024-03")]


def test_timeliness_deadline(spark):
    s = spark.createDataFrame([("a", "2024-02", dt.datetime(2024, 3, 15, 23)), ("b", "2024-02", dt.datetime(2024, 3, 16))],
                              "submission_id string, reporting_period string, received_at timestamp_ntz")
    got = {r.submission_id: (r.deadline, r.days_late, r.on_time) for r in governance.timeliness(s, 15).collect()}
    assert got == {"a": (dt.date(2024, 3, 15), 0, True), "b": (dt.date(2024, 3, 15), 1, False)}


def test_strict_least_and_epoch(spark):
    r = spark.range(1).select(strict_least(F.lit(None).cast("double"), F.lit(1.0)).alias("a"),
                              strict_least(F.lit(2.0), F.lit(1.0)).alias("b"),
                              epoch_millis_to_ntz(F.lit(1704067210123)).alias("t")).collect()[0]
    assert r.a is None and r.b == 1.0 and r.t == dt.datetime(2024, 1, 1, 0, 0, 10, 123000)
    back = spark.range(1).select(ntz_to_epoch_millis(F.lit("2024-01-01 00:00:10.123456")
                                                     .cast("timestamp_ntz")).alias("m")).collect()[0]
    assert back.m == 1704067210123


def test_reference_load_and_table_ops(spark):
    root = tempfile.mkdtemp(prefix="lakepipe-ref-")
    os.makedirs(os.path.join(root, "code-lists"))
    with open(os.path.join(root, "institutions.csv"), "w") as fh:
        fh.write("institution_id,institution_name,institution_type,peer_group,size_band,active_from\n"
                 "FI001,Bank 1,COMMERCIAL_BANK,PG-CB,LARGE,2020-01-01\n")
    for name in ("lcr_line_codes", "currencies", "institution_types", "return_types"):
        src = reference.RESOURCES / "reference" / f"{name}.csv"
        with open(os.path.join(root, reference.REFERENCE_FILES[name]), "w") as fh:
            fh.write(src.read_text())
    counts = reference.load_reference(spark, root, os.path.join(root, "tables"))
    assert counts == {"institutions": 1, "lcr_line_codes": 7, "currencies": 7, "institution_types": 4,
                      "return_types": 2}
    assert reference.load_reference(spark, root, os.path.join(root, "tables")) == counts    # idempotent
    w = spark.read.parquet(os.path.join(root, "tables", "lcr_line_codes"))
    assert dict(rows(w, "line_code", "weight"))["HQLA_L2A"] == Decimal("0.85")
    assert tables.oldest(w, "weight").collect()[0].line_code == "HQLA_L2B"


def test_schema_evolution_reads_old_rows_as_null(spark):
    root = tempfile.mkdtemp(prefix="lakepipe-evo-")
    spark.createDataFrame([(1,)], "id int").write.parquet(os.path.join(root, "t", "p=1"))
    spark.createDataFrame([(2, "x")], "id int, note string").write.parquet(os.path.join(root, "t", "p=2"))
    got = rows(governance.read_evolving(spark, os.path.join(root, "t")), "id", "note")
    assert got == [(1, None), (2, "x")]


def test_extra_columns_against_contract(spark):
    df = spark.createDataFrame([("FI001", "2024-01", "HQLA_L1", "MYR", 1.0, "x")],
                               "institution_id string, reporting_period string, line_code string, currency string, "
                               "amount double, comment string")
    assert governance.extra_columns(df, load_contract()) == ["comment"]
    assert governance.extra_columns(df, load_contract(), allowed=("comment",)) == []


def test_quoted_csv_fields(spark):
    q = '"'
    header = ",".join(q + c + q for c in H.split(","))
    content = (header + "\n"
               + ",".join(q + v + q for v in ["FI001", "2024-01", "HQLA_L1", "MYR", "1000.00"]) + "\n"
               + "FI001,2024-01," + q + "OUT_RETAIL" + q + "," + q + q + "," + q + "1,000.00" + q + "\n"
               + "FI001,2024-01,IN_TOTAL,MYR,5\n")
    r = _validate(spark, content, 3, 1005.0)
    assert r.errors == ["line 3: currency is required", "line 3: amount='1,000.00' is not a number"]
    assert r.record_count == 3


def test_split_fields_matches_python_csv(spark):
    import csv
    import io
    lines = ['a,b,c', '"a,1",b,', '"x""y",,z', ',,', '"",a']
    got = spark.createDataFrame([(l,) for l in lines], "l string").select(
        structure.split_fields(F.col("l")).alias("f")).collect()
    assert [list(r.f) for r in got] == [next(csv.reader(io.StringIO(l))) for l in lines]
