import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketlens.functions.ordering import describe, distinct_values, ntile, quantiles, rank_rows, running_totals


def skewed(n: int = 3000, seed: int = 7) -> list[float]:
    """A third of all values are the same."""
    rng = random.Random(seed)
    return [0.0 if rng.random() < 0.34 else round(rng.paretovariate(1.2) * 10, 2) for _ in range(n)]


def test_quantiles_match_numpy_on_skewed_values(spark):
    values = skewed()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    got = quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}).first()
    want = np.quantile(values, [0, 0.25, 0.5, 0.95, 1])
    assert np.allclose(list(got), want)


def test_describe_matches_pandas_per_group(spark):
    values = skewed(1200)
    pdf = pd.DataFrame({"g": ["ab"[i % 3 == 0] for i in range(len(values))], "v": values})
    got = {r["g"]: r for r in describe(spark.createDataFrame(pdf), "v", ["g"]).collect()}
    for g, part in pdf.groupby("g")["v"]:
        r = got[g]
        assert r["n"] == len(part) and r["null_count"] == 0
        assert np.isclose(r["mean"], part.mean()) and np.isclose(r["std"], part.std())
        assert np.isclose(r["skewness"], part.skew()) and np.isclose(r["median"], part.median())


def test_describe_small_and_null_groups(spark):
    df = spark.createDataFrame([("one", 5.0), ("none", None), ("two", 1.0), ("two", None)], "g string, v double")
    got = {r["g"]: r for r in describe(df, "v", ["g"]).collect()}
    assert (got["one"]["n"], got["one"]["std"], got["one"]["median"]) == (1, 0.0, 5.0)
    assert (got["none"]["n"], got["none"]["null_count"], got["none"]["mean"]) == (0, 1, None)
    assert got["two"]["null_count"] == 1


def test_running_totals_equal_a_plain_window(spark):
    values = skewed(800)
    per_value = distinct_values(spark.createDataFrame([(v,) for v in values], "v double"), "v")
    got = running_totals(per_value, [F.col("v").desc()], ["n"]).toPandas().sort_values("v", ascending=False)
    counts = pd.Series(values).value_counts().sort_index(ascending=False)
    assert list(got["n"]) == list(counts)
    assert list(got["before_n"]) == list(counts.cumsum() - counts)
    assert set(got["total_n"]) == {len(values)}


def test_rank_rows_orders_ties_by_key_and_ntile_matches(spark):
    values = skewed(700)
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    ranked = rank_rows(df, "v", "id").withColumn("tile", ntile(F.col("row_number"), F.col("total_n"), 5))
    got = ranked.toPandas().sort_values("row_number")
    want = pd.DataFrame({"id": range(len(values)), "v": values}).sort_values(["v", "id"], ascending=[False, True])
    assert list(got["id"]) == list(want["id"])
    assert list(got["row_number"]) == list(range(1, len(values) + 1))
    assert np.allclose(got["before_value"], want["v"].cumsum() - want["v"])
    sizes = got.groupby("tile").size()
    assert list(sizes) == [140] * 5 and got["tile"].is_monotonic_increasing
