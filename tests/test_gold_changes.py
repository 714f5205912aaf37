"""Gold by change equals a full rebuild after moves, empties, re-deliveries and repeated lines."""
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from lakepipe.operators import gold
from lakepipe.operators.gold_changes import apply_changes, contributions, gold_of, line_changes

LINES = "institution_id string, reporting_period string, line_code string, currency string, amount decimal(20,2), submission_id string"


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame([("h", "HQLA", Decimal("0.85")), ("o", "OUTFLOW", Decimal("1")), ("i", "INFLOW", Decimal("1"))],
                                 "line_code string, category string, weight decimal(5,4)")


@pytest.fixture(scope="module")
def institutions(spark):
    return spark.createDataFrame([("a", "A", "bank", "p"), ("b", "B", "bank", "q")],
                                 "institution_id string, institution_name string, institution_type string, peer_group string")


def silver(seed: int, pairs=("a", "b", "c")):
    r = random.Random(seed)
    return [(inst, period, r.choice("hhooix"), "EUR", r.choice([None, Decimal(r.randint(0, 9999)) / 100]), f"{inst}-{r.randint(1, 3)}")
            for inst in pairs for period in ("2024-01", "2024-02", "2024-13", None) for _ in range(r.choice([0, 1, 6]))]


@pytest.mark.parametrize("seed", range(3))
def test_changes_equal_a_full_rebuild(spark, codes, institutions, seed):
    steps = [silver(seed), silver(seed + 100) + silver(seed)[:5] * 2, [], silver(seed + 7)]
    state = contributions(spark.createDataFrame(steps[0], LINES), codes)
    for k in range(1, len(steps)):
        was, now = (spark.createDataFrame(s, LINES) for s in steps[k - 1:k + 1])
        keys = was.unionByName(now).where("reporting_period IS NOT NULL")
        same = [x for x in steps[k - 1] if x[1] is None]      # a pair that no delivery touches keeps its lines
        steps[k] = [x for x in steps[k] if x[1] is not None] + same
        now = spark.createDataFrame(steps[k], LINES)
        state = spark.createDataFrame(apply_changes(state, line_changes(was, now, keys), codes).collect(), state.schema)
        full = gold.build_gold(now, codes, institutions, build_ts=False)
        assert sorted(map(str, gold_of(state, institutions).collect())) == sorted(map(str, full.collect()))


def test_only_lines_that_differ_are_changes(spark):
    line = ("a", "2024-01", "h", "EUR", Decimal("1.00"), "s")
    was, now = spark.createDataFrame([line] * 3, LINES), spark.createDataFrame([line] * 2, LINES)
    assert rows(line_changes(was, now, was), "submission_id", "n") == [("s", -1)]
    assert line_changes(was, was, was).count() == 0 and line_changes(was, now, was.limit(0)).count() == 0


def test_changes_of_another_state_are_refused(spark, codes):
    df = spark.createDataFrame([("a", "2024-01", "h", "EUR", Decimal("1.00"), "s")], LINES)
    empty = contributions(df.limit(0), codes)
    with pytest.raises(PySparkException, match="more lines removed"):
        apply_changes(empty, line_changes(df, df.limit(0), df), codes).collect()
