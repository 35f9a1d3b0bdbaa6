"""A sample of registered queries against their SQL oracles; verification.check runs them all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from verification.check import TABLES, rows_of

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables absent")
SAMPLE = [
    "sql_rfm",
    "sql_monthly_growth",
    "sql_cohort",
    "sql_seller_pareto",
    "rfm_quantile_scores",
    "seller_performance",
    "pareto_customers",
    "test_kruskal_states",
    "eda_value_tiers",
    "eda_iqr_outliers",
    "eda_satisfaction",
    "feature_store",
    "temporal_features",
    "cust_city",
    "clean_dedup",
    "dq_invalid_rows",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, BASE)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(cur.fetchall(), columns)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
