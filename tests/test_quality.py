"""Rule engine semantics (D0-D8) on hand-made rows."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakepipe.contracts import Rule, RuleSet, load_rules, rules_from_dict
from lakepipe.operators import quality
from conftest import rows

SCHEMA = "submission_id string, institution_id string, reporting_period string, line_code string, " \
         "currency string, amount decimal(20,2)"


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _res(df, *ids, submissions=None):
    rs = load_rules("lcr-monthly").only(*ids)
    out = quality.evaluate(df, rs, "bronze", submissions=submissions)
    return {(r.submission_id, r.rule_id): (r.records_tested, r.records_failed, r.outcome)
            for r in out.collect()}


def test_not_null_counts_each_row_once(spark):
    df = _df(spark, [("s1", None, None, "HQLA_L1", "MYR", Decimal("1")),
                     ("s1", "FI001", "2024-01", "HQLA_L1", "MYR", None),
                     ("s1", "FI001", "2024-01", "HQLA_L1", "MYR", Decimal("2"))])
    assert _res(df, "LCR-001")[("s1", "LCR-001")] == (3, 2, "FAIL")


def test_accepted_values_null_fails_range_null_passes(spark):
    df = _df(spark, [("s1", "FI001", "2024-01", None, None, None),
                     ("s1", "FI001", "2024-01", "BAD", "XXX", Decimal("-1")),
                     ("s1", "FI001", "2024-01", "IN_TOTAL", "MYR", Decimal("0"))])
    r = _res(df, "LCR-002", "LCR-003", "LCR-004")
    assert r[("s1", "LCR-002")][1] == 2
    assert r[("s1", "LCR-003")][1] == 2
    assert r[("s1", "LCR-004")][1] == 1       # NULL passes, 0 is inside [0, inf)


def test_unique_counts_key_groups_and_groups_nulls(spark):
    df = _df(spark, [("s1", "FI001", "2024-01", "HQLA_L1", "MYR", Decimal("1"))] * 3 +
                    [("s1", "FI001", "2024-01", None, "MYR", Decimal("1"))] * 2 +
                    [("s1", "FI001", "2024-01", "IN_TOTAL", "MYR", Decimal("1"))])
    assert _res(df, "LCR-005")[("s1", "LCR-005")] == (6, 2, "FAIL")


def test_aggregate_expression_and_empty_submission(spark):
    codes = ["HQLA_L1", "HQLA_L2A", "HQLA_L2B", "OUT_RETAIL", "OUT_WHOLESALE", "OUT_OTHER", "IN_TOTAL"]
    full = [("s1", "FI001", "2024-01", c, "MYR", Decimal("1")) for c in codes]
    short = full[:-1]
    df = _df(spark, full + [("s2",) + r[1:] for r in short])
    subs = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "submission_id string")
    r = _res(df, "LCR-006", "LCR-001", submissions=subs)
    assert r[("s1", "LCR-006")] == (7, 0, "PASS")
    assert r[("s2", "LCR-006")] == (6, 1, "FAIL")
    # no rows at all: the aggregate rule is still evaluated (count distinct = 0)
    assert r[("s3", "LCR-006")] == (0, 1, "FAIL")
    assert r[("s3", "LCR-001")] == (0, 0, "PASS")


def test_row_expression_null_passes(spark):
    g = spark.createDataFrame([("FI001", 0.2), ("FI001", None), ("FI001", 3.0)],
                              "institution_id string, lcr_ratio double")
    rs = load_rules("lcr-monthly").only("LCR-101")
    r = quality.evaluate(g, rs, "gold", key="institution_id").collect()[0]
    assert (r.records_tested, r.records_failed, r.severity) == (3, 1, "warning")


def test_gate_blocking_only(spark):
    res = spark.createDataFrame(
        [("s1", "blocking", "PASS"), ("s1", "warning", "FAIL"), ("s2", "blocking", "FAIL")],
        "submission_id string, severity string, outcome string")
    assert rows(quality.gate(res), "submission_id", "status") == [("s1", "ACCEPTED"), ("s2", "QUARANTINED")]


def test_unknown_rule_type_fails_before_any_job():
    with pytest.raises(ValueError, match="Unknown rule type"):
        rules_from_dict({"contract": "x", "version": 1, "rules": [
            {"id": "X", "stage": "bronze", "dimension": "d", "type": "nope", "severity": "blocking"}]})


def test_string_range_under_ansi_does_not_raise(spark):
    df = spark.createDataFrame([("s1", "5"), ("s1", "abc"), ("s1", "-2")], "submission_id string, v string")
    rs = RuleSet("t", "1", (Rule("R", "bronze", "validity", "range", "blocking", column="v", min=0),))
    r = quality.evaluate(df, rs).collect()[0]
    assert r.records_failed == 1


def test_one_aggregate_per_input(spark):
    """All row and aggregate rules share one grouped aggregate (plus one per unique rule)."""
    df = _df(spark, [("s1", "FI001", "2024-01", "HQLA_L1", "MYR", Decimal("1"))])
    out = quality.evaluate(df, load_rules("lcr-monthly"), "bronze")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
