"""The splittable large-file validation equals the whole-file validation."""
import os
import tempfile

from pyspark.sql import functions as F

from fixtures import HEADER, write_submission
from lakepipe.contracts import load_contract
from lakepipe.operators import structure
from lakepipe.operators.structure_large import numbered_records, report_rows, validate_large
from lakepipe.sources import raw, tables


def _write_messy(folder):
    rows = [f"FI001,2024-01,HQLA_L1,MYR,{i}.50" for i in range(300)]
    rows[5] = "FI01,2024/01,HQLA_L1,,x"
    rows[17] = ""                                   # blank line: not a record
    rows[250] = "FI001,2024-01,IN_TOTAL,MYR,1_000"
    body = HEADER + "\n" + "\n".join(rows) + "\n\n"
    return write_submission(folder, "FI001", "2024-01", 1, body=body.encode())


def test_large_path_matches_whole_file_path(spark):
    land = tempfile.mkdtemp(prefix="lakepipe-large-")
    _write_messy(land)
    for inst, inj in [("FI002", None), ("FI003", "manifest_mismatch"), ("FI004", "bad_currency")]:
        write_submission(land, inst, "2024-01", 1, inj)
    many = HEADER + "\n" + "\n".join(f"FI005,2024-01,HQLA_L1,MYR,x{i}" for i in range(450)) + "\n"
    write_submission(land, "FI005", "2024-01", 1, body=many.encode())      # > 200 errors

    whole = structure.validate(raw.files_with_manifests(spark, land), load_contract())
    w_sum = {r.path: (r.record_count, r.control_total, r.n_errors, r.status) for r in whole.collect()}
    w_err = {r.path: list(r.all_errors) for r in whole.collect()}

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")      # many blocks per file
    try:
        mans = raw.scan_manifests(spark, land).select(F.col("data_path").alias("path"), "manifest")
        summary, errors = validate_large(spark, os.path.join(land, "*.csv"), mans, load_contract())
        l_sum = {r.path: (r.record_count, r.control_total, r.n_errors, r.status) for r in summary.collect()}
        l_err = {}
        for r in errors.orderBy("path", "error_no").collect():
            l_err.setdefault(r.path, []).append(r.message)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert l_sum == w_sum
    assert {p: l_err.get(p, []) for p in w_err} == w_err
    messy = [p for p in w_err if "FI001" in p][0]
    # rows[250] is record 250 (one blank line before it is skipped) -> line 251, not 252
    assert "line 251: amount='1_000' is not a number" in w_err[messy]
    # the error table holds all errors (450 lines, the count and the total), the report the first 200
    assert max(len(v) for v in l_err.values()) == 452
    reported = report_rows(summary, errors).collect()
    assert max(len(r.errors) for r in reported) == 200 and max(len(r.detail_errors) for r in reported) == 20


def test_unclosed_quote_near_the_start_gathers_nothing(spark):
    """All lines after an unclosed quote are one record: an error by its place, its lines stay apart."""
    land = tempfile.mkdtemp(prefix="lakepipe-unclosed-")
    rows = [f"FI001,2024-01,HQLA_L1,MYR,{i}.50" for i in range(400)]
    rows[2] = ""
    rows[5] = 'FI001,2024-01,"HQLA_L1,MYR,5.50'
    write_submission(land, "FI001", "2024-01", 1, body=(HEADER + "\n" + "\n".join(rows) + "\n").encode())
    rows[300] = 'FI002,2024-01,"HQLA_L1",MYR,5.50'                        # closes and opens again inside the record
    write_submission(land, "FI002", "2024-01", 1, body=(HEADER + "\r\n" + "\r\n".join(rows) + "\r\n").encode())
    write_submission(land, "FI003", "2024-01", 1, body=(HEADER.replace("amount", '"amount') + "\n" + rows[0] + "\n").encode())
    whole = {r.path: r for r in structure.validate(raw.files_with_manifests(spark, land), load_contract()).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        paths = os.path.join(land, "*.csv")
        records = tables.stage(spark, numbered_records(spark, paths), "test-records")
        mans = raw.scan_manifests(spark, land).select(F.col("data_path").alias("path"), "manifest")
        summary, errors = validate_large(spark, paths, mans, load_contract(), records=records)
        summary = {r.path: (r.record_count, r.control_total, r.n_errors, r.status) for r in summary.collect()}
        found = {}
        for r in errors.orderBy("path", "error_no").collect():
            found.setdefault(r.path, []).append(r.message)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert records.agg(F.max(F.length("value"))).first()[0] < 100
    assert summary == {p: (r.record_count, r.control_total, r.n_errors, r.status) for p, r in whole.items()}
    assert found == {p: list(r.all_errors) for p, r in whole.items()}
    for p, messages in found.items():
        if "FI003" not in p:
            assert messages[0] == "line 6: quote not closed in the record that starts in line 7 of the file"
            assert whole[p].record_count == 5 and whole[p].status == "REJECTED"
        else:
            assert messages[0].startswith("header [] != contract")
