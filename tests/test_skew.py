import pytest
from pyspark.sql import functions as F

from marketlens.functions import skew
from marketlens.operators.eda_products import freight_correlation


def facts(spark, n=9000):
    """Key 0 holds a third of the rows, null another tenth; the others are spread."""
    k = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500 + 1)
    return spark.range(n).select("id", k.alias("k")).repartition(16)


def side(spark):
    return spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))  # some keys are missing


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.001, 0.1, 1.0])
def test_equals_the_plain_join(spark, how, share):
    got = skew.join_by_frequency(facts(spark), side(spark), "k", how, share).select("id", "k", "v")
    want = facts(spark).join(side(spark), "k", how).select("id", "k", "v")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_heavy_keys_are_few_and_stay_where_they_are(spark):
    spread = facts(spark)
    assert [r["k"] for r in skew.heavy_keys(spread, "k", 0.1).collect()] == [0]
    assert skew.heavy_keys(spread, "k").count() < 1 / skew.SHARE
    joined = skew.join_by_frequency(spread, side(spark), "k", "left", 0.1)
    parts = [r["n"] for r in joined.filter("k = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 8 and max(parts) < 1000  # 3000 rows of one key, none of them gathered
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "hint" in plan.lower() or "broadcast" in plan


def test_missing_side_and_empty_tables(spark):
    none = side(spark).limit(0)
    assert skew.join_by_frequency(facts(spark), none, "k", "left", 0.1).count() == 9000
    assert skew.join_by_frequency(facts(spark), none, "k", "inner", 0.1).count() == 0
    assert skew.join_by_frequency(facts(spark).limit(0), side(spark), "k", "left").count() == 0
    with pytest.raises(ValueError):
        skew.join_by_frequency(facts(spark), side(spark), "k", "full")


def test_freight_correlation_from_reduced_products(spark):
    items = spark.range(600).select((F.col("id") % 7).alias("product_id"), F.when(F.col("id") % 11 > 0, (F.col("id") % 13) * 1.5 + F.col("id") % 7).alias("freight_value"))
    products = spark.createDataFrame([(i, 10.0 * i * i + 1 if i != 3 else None, float(i % 4)) for i in range(6)], "product_id long, product_weight_g double, product_volume_cm3 double")
    got = freight_correlation(items, products).first()
    want = items.join(products, "product_id").agg(F.corr("freight_value", "product_weight_g"), F.corr("freight_value", "product_volume_cm3")).first()
    assert tuple(got) == pytest.approx([round(x, 4) for x in want], abs=1e-4)
