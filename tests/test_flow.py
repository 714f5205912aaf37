"""End-to-end batch flow over real files: the expected verdict per injected error."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fixtures import write_submission
from lakepipe.plans.lcr_flow import read_table, run_lcr_batch
from lakepipe.operators import bronze
from conftest import rows


@pytest.fixture(scope="module", params=["whole-file", "large-file"])
def flow(spark, request):
    """The same landing folder through the whole-file path and through the large-file path."""
    large_bytes = 0 if request.param == "large-file" else 256 * 1024 * 1024
    root = tempfile.mkdtemp(prefix="lakepipe-flow-")
    land = os.path.join(root, "landing")
    cases = {"FI001": None, "FI002": "negative_amount", "FI003": "missing_line",
             "FI004": "bad_currency", "FI005": "duplicate_row", "FI006": "manifest_mismatch"}
    t = 1_700_000_000
    for i, (inst, inj) in enumerate(cases.items()):
        p = write_submission(land, inst, "2024-01", 1, inj)
        os.utime(p, (t + i, t + i))
    first = os.path.join(land, "FI001_LCR_2024-01_v1.csv")
    body = open(first, "rb").read()
    p = write_submission(land, "FI007", "2024-01", 1, body=body)            # same bytes as FI001
    os.utime(p, (t + 50, t + 50))
    write_submission(land, "FI008", "2024-01", 1, name="FI008_LCR_2024_v1.csv")   # bad name
    write_submission(land, "FI009", "2024-01", 1, manifest=False)
    write_submission(land, "FI010", "2024-01", 1, bad_sha=True)
    bad = open(first, "rb").read().replace(b"MYR", b"MY\xff", 1)                  # not UTF-8
    write_submission(land, "FI011", "2024-01", 1, body=bad)
    inst = spark.createDataFrame([(f"FI{i:03d}", f"Bank {i}", "COMMERCIAL_BANK", "PG-CB") for i in range(1, 11)],
                                 "institution_id string, institution_name string, institution_type string, "
                                 "peer_group string")
    out = run_lcr_batch(spark, land, os.path.join(root, "wh"), inst, large_bytes=large_bytes)
    return out, root, land, inst, large_bytes


def test_intake_verdicts(flow):
    out = flow[0]
    got = dict(rows(out["intake"].select(F.regexp_extract("file_name", "^(FI[0-9]{3})", 1).alias("i"),
                                         "verdict"), "i", "verdict"))
    assert got["FI007"] == "DUPLICATE"
    assert got["FI008"] == got["FI009"] == got["FI010"] == "REJECTED"
    assert all(got[f"FI00{i}"] == "RECEIVED" for i in range(1, 7)) and got["FI011"] == "RECEIVED"


def test_golden_statuses(flow):
    status = dict(rows(flow[0]["status"], "submission_id", "status"))
    assert status == {"FI001-LCR-2024-01-v1": "PUBLISHED", "FI002-LCR-2024-01-v1": "QUARANTINED",
                      "FI003-LCR-2024-01-v1": "QUARANTINED", "FI004-LCR-2024-01-v1": "QUARANTINED",
                      "FI005-LCR-2024-01-v1": "QUARANTINED", "FI006-LCR-2024-01-v1": "REJECTED",
                      "FI011-LCR-2024-01-v1": "REJECTED"}


def test_failing_rule_per_injection(flow):
    fails = rows(flow[0]["dq"].where("outcome = 'FAIL'"), "submission_id", "rule_id", "records_failed")
    assert fails == [("FI002-LCR-2024-01-v1", "LCR-004", 1), ("FI003-LCR-2024-01-v1", "LCR-006", 1),
                     ("FI004-LCR-2024-01-v1", "LCR-003", 1), ("FI005-LCR-2024-01-v1", "LCR-005", 1)]


def test_structural_reject_reason(flow):
    v = flow[0]["validated"].where("submission_id = 'FI006-LCR-2024-01-v1'").collect()[0]
    assert v.status == "REJECTED" and v.errors == ["record count 7 != manifest 8"]


def test_not_utf8_rejected_with_one_error(flow):
    v = flow[0]["validated"].where("submission_id = 'FI011-LCR-2024-01-v1'").collect()[0]
    assert v.status == "REJECTED" and v.errors == ["file is not valid UTF-8"]


def test_gold_only_accepted(flow):
    g = flow[0]["gold"].collect()
    assert [(r.institution_id, r.submission_ids) for r in g] == [("FI001", "FI001-LCR-2024-01-v1")]
    assert g[0].lcr_ratio is not None


def test_replay_is_idempotent(spark, flow):
    root = flow[1]
    path = os.path.join(root, "wh")
    rows_now = lambda: bronze.current(read_table(spark, path, "bronze"))
    before = rows_now().count()
    again = rows_now().where("submission_id = 'FI001-LCR-2024-01-v1'")
    again = spark.createDataFrame(again.collect(), again.schema)
    bronze.replace_submissions(spark, path, again)
    bronze.replace_submissions(spark, path, again)
    assert rows_now().count() == before


def test_second_run_finds_duplicates(spark, flow):
    out, root, land, inst, large_bytes = flow
    again = run_lcr_batch(spark, land, os.path.join(root, "wh"), inst, large_bytes=large_bytes)
    verdicts = {r.verdict for r in again["intake"].select("verdict").collect()}
    assert "RECEIVED" not in verdicts


def test_incremental_rebuild_equals_full_rebuild(spark):
    from lakepipe.operators import gold, silver
    from lakepipe.sources import reference
    from fixtures import submission_rows
    root = tempfile.mkdtemp(prefix="lakepipe-incr-")
    land, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    inst = spark.createDataFrame([(f"FI{i:03d}", f"Bank {i}", "COMMERCIAL_BANK", "PG-CB") for i in range(1, 4)],
                                 "institution_id string, institution_name string, institution_type string, "
                                 "peer_group string")
    write_submission(land, "FI001", "2024-01", 1)
    write_submission(land, "FI002", "2024-01", 1)
    run_lcr_batch(spark, land, wh, inst)
    rows_v2 = submission_rows("FI001", "2024-01")
    rows_v2[0][4] = "5000.00"                                  # v2 changes one line
    write_submission(land, "FI001", "2024-01", 2, rows=rows_v2)
    write_submission(land, "FI003", "2024-02", 1)
    out = run_lcr_batch(spark, land, wh, inst)

    b = bronze.current(read_table(spark, wh, "bronze"))
    dq = read_table(spark, wh, "dq_results").where("stage = 'bronze'")
    full_s = silver.build_silver(b, dq, build_ts=False)
    full_g = gold.build_gold(full_s, reference.line_codes(spark), inst, build_ts=False)
    s_cols = [c for c in full_s.columns]
    g_cols = [c for c in full_g.columns]
    assert rows(out["silver"].select(*s_cols)) == rows(full_s)
    assert rows(out["gold"].select(*g_cols)) == rows(full_g)
    got = {r.institution_id + r.reporting_period: r.submission_ids for r in out["gold"].collect()}
    assert got == {"FI0012024-01": "FI001-LCR-2024-01-v2", "FI0022024-01": "FI002-LCR-2024-01-v1",
                   "FI0032024-02": "FI003-LCR-2024-02-v1"}
