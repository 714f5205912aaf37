"""Silver / Gold semantics on hand-made rows (F1-F3, G1-G8, H)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lakepipe.operators import checks, gold, silver
from lakepipe.sources import reference
from conftest import rows

BRONZE = ("institution_id string, reporting_period string, line_code string, currency string, "
          "amount decimal(20,2), submission_id string, submission_version int, source_uri string, "
          "source_sha256 string, loaded_at timestamp_ntz")
T0 = dt.datetime(2024, 2, 10)
T1 = dt.datetime(2024, 2, 12)


def _b(spark, data):
    return spark.createDataFrame(data, BRONZE)


def _row(inst, code, amt, v, t=T0, cur="MYR", period="2024-01"):
    return (inst, period, code, cur, Decimal(amt), f"{inst}-LCR-{period}-v{v}", v, "u", "h", t)


def test_latest_version_per_line_and_currency_rows_survive(spark):
    b = _b(spark, [_row("FI001", "HQLA_L1", "10", 1), _row("FI001", "HQLA_L1", "20", 2, T1),
                   _row("FI001", "OUT_RETAIL", "5", 1), _row("FI001", "OUT_RETAIL", "6", 2, cur="USD")])
    s = silver.build_silver(b, build_ts=False)
    assert rows(s, "line_code", "currency", "amount", "submission_version") == [
        ("HQLA_L1", "MYR", Decimal("20.00"), 2), ("OUT_RETAIL", "MYR", Decimal("5.00"), 1),
        ("OUT_RETAIL", "USD", Decimal("6.00"), 2)]


def test_submission_grain_keeps_one_version(spark):
    b = _b(spark, [_row("FI001", "HQLA_L1", "10", 1), _row("FI001", "OUT_RETAIL", "5", 1),
                   _row("FI001", "HQLA_L1", "20", 2, T1)])
    s = silver.build_silver(b, grain="submission", build_ts=False)
    assert rows(s, "line_code", "submission_version") == [("HQLA_L1", 2)]


def test_sticky_vs_latest_run_quarantine(spark):
    b = _b(spark, [_row("FI001", "HQLA_L1", "10", 1), _row("FI002", "HQLA_L1", "10", 1)])
    dq = spark.createDataFrame(
        [("FI001-LCR-2024-01-v1", "bronze", "blocking", "FAIL", T0),
         ("FI001-LCR-2024-01-v1", "bronze", "blocking", "PASS", T1),
         (None, "bronze", "blocking", "FAIL", T0)],
        "submission_id string, stage string, severity string, outcome string, checked_at timestamp_ntz")
    sticky = silver.build_silver(b, dq, "sticky", build_ts=False)
    latest = silver.build_silver(b, dq, "latest_run", build_ts=False)
    assert rows(sticky, "institution_id") == [("FI002",)]          # NULL sid does not empty the result
    assert rows(latest, "institution_id") == [("FI001",), ("FI002",)]


def _gold(spark, lines):
    b = _b(spark, [_row("FI001", c, a, 1) for c, a in lines])
    inst = spark.createDataFrame([("FI001", "Bank 1", "COMMERCIAL_BANK", "PG-CB")],
                                 "institution_id string, institution_name string, institution_type string, "
                                 "peer_group string")
    return gold.build_gold(silver.build_silver(b, build_ts=False), reference.line_codes(spark), inst,
                           build_ts=False).collect()[0]


def test_gold_ratio_formula(spark):
    g = _gold(spark, [("HQLA_L1", "100"), ("HQLA_L2A", "100"), ("HQLA_L2B", "100"),
                      ("OUT_RETAIL", "100"), ("OUT_WHOLESALE", "50"), ("OUT_OTHER", "50"),
                      ("IN_TOTAL", "300"), ("UNKNOWN", "999")])
    assert g.hqla == 235.0                     # 100 + 85 + 50, unknown code dropped
    assert (g.outflows, g.inflows) == (200.0, 300.0)
    assert g.net_outflows == 50.0              # inflows capped at 75 % of outflows
    assert g.lcr_ratio == 4.7
    assert g.institution_name == "Bank 1"


def test_gold_null_inflows_give_null_ratio(spark):
    g = _gold(spark, [("HQLA_L1", "100"), ("OUT_RETAIL", "100")])
    assert g.inflows is None and g.net_outflows is None and g.lcr_ratio is None


def test_gold_zero_net_outflows_give_null_not_error(spark):
    g = _gold(spark, [("HQLA_L1", "100"), ("OUT_RETAIL", "0"), ("IN_TOTAL", "0")])
    assert g.net_outflows == 0.0 and g.lcr_ratio is None


def test_model_tests_and_gate(spark):
    s = spark.createDataFrame([("FI001", "2024-01", "HQLA_L1", "MYR", Decimal("1")),
                               ("FI001", "2024-01", "HQLA_L1", "MYR", Decimal("2")),
                               ("FI001", "2024-01", None, "MYR", None)],
                              "institution_id string, reporting_period string, line_code string, "
                              "currency string, amount decimal(20,2)")
    res = checks.run_model_tests(s, checks.silver_tests(("HQLA_L1",)), "silver")
    got = {r.rule_id: r.records_failed for r in res.collect()}
    assert got["not_null_silver_amount"] == 1
    assert got["accepted_values_silver_line_code"] == 0      # NULL ignored (model-test semantics)
    assert got["assert_one_current_version"] == 1
    try:
        checks.enforce(res)
        raise AssertionError("expected BuildTestError")
    except checks.BuildTestError as e:
        assert "assert_one_current_version" in str(e)
