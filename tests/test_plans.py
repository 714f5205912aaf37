"""Plan hygiene of every registered query: JVM-only expressions, no cross joins, pruned scans."""
import re

import pytest

from conftest import SF

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "FlatMapCoGroupsInPandas")
CROSS_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
FULL_WIDTH = {"lineitem": 11, "orders": 6, "events": 6, "documents": 5}


def _names():
    from lakepipe.plans.catalog import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_plan_is_jvm_only_and_pruned(spark, name):
    from lakepipe.plans.catalog import QUERIES
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PYTHON_NODES if n in plan], name
    assert not [n for n in CROSS_JOINS if n in plan], name
    for line in plan.splitlines():
        m = re.search(r"FileScan parquet [^\[]*\[([^\]]*)\]", line)
        if not m:
            continue
        for table, width in FULL_WIDTH.items():
            if f"/{table}.parquet" in line:
                assert len(m.group(1).split(",")) < width, (name, table, m.group(1))
