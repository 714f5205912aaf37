"""Post-build data tests on Silver and Gold (H1-H5).

Every test of a model is one aggregate over the model (not one job per test);
results have the ``dq_results`` shape with stage ``silver`` / ``gold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.contracts import Rule, RuleSet, load_rules
from lakepipe.operators import quality

SILVER_NOT_NULL = ["institution_id", "reporting_period", "line_code", "amount"]
GOLD_NOT_NULL = ["institution_id", "reporting_period", "lcr_ratio"]
SILVER_KEY = ["institution_id", "reporting_period", "line_code", "currency"]


class BuildTestError(RuntimeError):
    """An error-severity model test failed (the build stops here)."""


def _not_null_rules(model: str, columns: list[str]) -> list[Rule]:
    return [Rule(id=f"not_null_{model}_{c}", stage=model, dimension="completeness",
                 type="not_null", severity="error", columns=(c,)) for c in columns]


def silver_tests(line_codes: tuple[str, ...]) -> RuleSet:
    rules = _not_null_rules("silver", SILVER_NOT_NULL)
    # model tests' accepted_values ignore NULLs (unlike the Bronze rule engine).
    rules.append(Rule(id="accepted_values_silver_line_code", stage="silver", dimension="validity",
                      type="accepted_values", severity="error", column="line_code",
                      values=tuple(line_codes), ignore_null=True))
    rules.append(Rule(id="assert_one_current_version", stage="silver", dimension="uniqueness",
                      type="unique", severity="error", columns=tuple(SILVER_KEY)))
    return RuleSet("lcr-monthly", "model-tests", tuple(rules))


def gold_tests() -> RuleSet:
    rules = _not_null_rules("gold", GOLD_NOT_NULL)
    plausible = load_rules("lcr-monthly").only("LCR-101").rules
    return RuleSet("lcr-monthly", "model-tests", tuple(rules) + plausible)


def run_model_tests(model: DataFrame, tests: RuleSet, stage: str,
                    checked_at: Column | None = None) -> DataFrame:
    """All tests of one model in one pass."""
    wide = quality.evaluate_wide(model, tests, key=None)
    return quality.to_results(wide, tests, stage, key=None, checked_at=checked_at)


def one_current_version(silver: DataFrame) -> DataFrame:
    """H3 as a query: keys with more than one current row (must be empty)."""
    return (silver.groupBy(*SILVER_KEY).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def implausible_ratios(gold: DataFrame) -> DataFrame:
    """H4 / LCR-101 as a query: ratios outside [0.5, 10]; NULL passes."""
    return (gold.where(~F.col("lcr_ratio").between(0.5, 10))
            .select("institution_id", "reporting_period", "lcr_ratio"))


def enforce(results: DataFrame) -> DataFrame:
    """Raise when an error-severity test failed; warnings are only recorded (H5)."""
    bad = (results.where((F.col("severity").isin("error", "blocking")) & (F.col("outcome") == "FAIL"))
           .select("rule_id").distinct().collect())   # a handful of test ids, not data
    if bad:
        raise BuildTestError("failed tests: " + ", ".join(sorted(r.rule_id for r in bad)))
    return results
