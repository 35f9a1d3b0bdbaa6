"""Plan checks on registered queries: nothing in Python, no whole table in one task."""

import os
import re

import pytest

import __spark_entry__ as entry

BASE = "/root/testdata/sf0.001"
QUERIES = [
    "sql_rfm",
    "sql_monthly_growth",
    "sql_cohort",
    "sql_seller_pareto",
    "seller_performance",
    "pareto_customers",
    "eda_customer_spend",
    "eda_satisfaction",
    "eda_pay_value_stats",
    "test_mannwhitney_spend",
    "feature_store",
    "temporal_features",
    "clean_dedup",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables absent")


def depth(line: str) -> int:
    return len(re.match(r"[\s:|+\-]*", line)[0])


@pytest.mark.parametrize("name", QUERIES)
def test_single_task_stages_only_see_aggregates(spark, name):
    plan = entry.queries()[name](spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|InPandas|CartesianProduct", plan)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = [x for x in lines[i + 1 :] if not re.search(r"[-\s:|+*(\d)]+(Project|Filter|Sort) ", x)]
            assert re.search(r"HashAggregate|SortAggregate|LocalLimit", below[0]), (name, below[0])


def test_pruning_reaches_the_scan(spark):
    plan = entry.queries()["sql_status_audit"](spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan  # delivery dates are unused, so their join is gone
    scan = next(x for x in plan.splitlines() if "orders.parquet" in x)
    assert "o_totalprice" not in scan and "o_orderpriority" not in scan
