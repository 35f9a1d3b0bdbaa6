import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators import advanced as A
from marketlens.operators import eda_delivery as D
from marketlens.operators import eda_payments as Y
from marketlens.operators import eda_products as P
from marketlens.operators import eda_sales as S
from marketlens.operators import profile as R


def test_unsold_products(spark):
    products = spark.createDataFrame([(i,) for i in range(20)], "product_id long")
    items = spark.createDataFrame([(i,) for i in range(5)], "product_id long")
    got = P.unsold_products(items, products).first()
    assert (got["unsold_count"], got["unsold_percentage"]) == (15, 75.0)
    assert got["sample_product_ids"] == ",".join(str(i) for i in range(5, 15))


def shares(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "seller_id long, price double")
    return A.pareto_sellers(df).first().asDict()


def test_pareto_edges(spark):
    got = shares(spark, [100] * 10)  # every seller ties at every edge
    assert [got[f"top_{p}_percent_revenue_share"] for p in (10, 20, 50)] == [10.0, 20.0, 50.0]
    got = shares(spark, [5])  # no whole seller fits below 50 %
    assert got["top_50_percent_revenue_share"] is None and got["total_sellers"] == 1
    assert shares(spark, [0, 0])["top_50_percent_revenue_share"] is None
    got = shares(spark, [90, 4, 3, 2, 1])
    assert (got["top_20_percent_revenue_share"], got["top_10_percent_revenue_share"]) == (90.0, None)


def test_concentration_rounds_up(spark):
    items = spark.createDataFrame([(i, float(v)) for i, v in enumerate([70, 20, 10])], "product_id long, price double")
    got = S.product_concentration(items).first()
    assert got["top_1_percent_share"] == got["top_20_percent_share"] == 70.0


def sales(spark, rows):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(d), float(v)) for i, (d, v) in enumerate(rows)], "order_id long, order_purchase_timestamp timestamp, order_value double")


def test_growth_over_gap_and_zero_months(spark):
    got = {r["year_month"]: r["growth_pct"] for r in S.revenue_growth(sales(spark, [("2017-01-05", 0), ("2017-02-05", 10), ("2017-04-05", 15)])).collect()}
    assert got == {"2017-01": 0.0, "2017-02": 0.0, "2017-04": 50.0}


def test_months_fall_back_when_none_has_ten_orders(spark):
    got = S.best_worst_months(sales(spark, [("2017-01-05", 1), ("2017-02-05", 2)])).filter("ranking = 'highest'").collect()
    assert [r["year_month"] for r in got] == ["2017-02", "2017-01"]


def test_event_days_are_tagged(spark):
    got = {r["date"]: r["event_context"] for r in S.daily_spikes(sales(spark, [("2017-11-24", 5), ("2017-11-26", 1)])).collect()}
    assert got == {"2017-11-24": "Black Friday 2017", "2017-11-26": "Standard Peak"}


def test_resample_fills_empty_periods(spark):
    got = R.resample_sum(sales(spark, [("2017-01-05", 3), ("2017-01-05", 4), ("2017-04-01", 1)]), "order_purchase_timestamp", "order_value", "month")
    assert [(r["period"], r["total"]) for r in got.orderBy("period").collect()] == [("2017-01-01", 7.0), ("2017-02-01", 0.0), ("2017-03-01", 0.0), ("2017-04-01", 1.0)]


def test_buckets_are_right_closed_and_complete(spark):
    rows = [(i, dt.datetime(2017, 1, 1), v, v) for i, v in enumerate([3.0, 3.01, 30.0, 31.0, None])]
    df = spark.createDataFrame(rows, "order_id long, order_delivered_customer_date timestamp, delivery_days double, delivery_delay_days double")
    got = {r["bucket"]: (r["count"], r["percentage"]) for r in D.delivery_buckets(df).collect()}
    assert got == {"0-3 days": (1, 20.0), "4-7 days": (1, 20.0), "8-14 days": (0, 0.0), "15-21 days": (0, 0.0), "22-30 days": (1, 20.0), ">30 days": (1, 20.0)}


def test_zero_installments_are_in_neither_kind(spark):
    pay = spark.createDataFrame([("a", 0, 10.0), ("b", 1, 30.0), ("c", 4, 60.0)], "order_id string, payment_installments int, payment_value double")
    got = {r["kind"]: (r["transactions"], r["revenue_percentage"]) for r in Y.installment_split(pay).collect()}
    assert got == {"one_time": (1, 30.0), "installment": (1, 60.0)}


def test_two_reviews_repeat_the_items_of_an_order_unless_deduplicated(spark):
    items = spark.createDataFrame([("o1", 1, "p1", "s", 10.0, 1.0), ("o1", 2, "p2", "s", 20.0, 1.0), ("o2", 1, "p1", "s", 5.0, 1.0)], "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double")
    when = dt.datetime(2017, 1, 10)
    orders = spark.createDataFrame([("o1", when, dt.datetime(2017, 1, 5)), ("o2", when, when)], "order_id string, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
    reviews = spark.createDataFrame([("o1", 5), ("o1", 1)], "order_id string, review_score int")
    fan = A.seller_performance(items, orders, reviews).first()
    assert (fan["total_revenue"], fan["total_items_sold"], fan["late_orders_count"], fan["late_delivery_rate"]) == (65.0, 5, 4, 2.0)
    one = A.seller_performance_dedup(items, orders, reviews).first()
    assert (one["total_revenue"], one["total_items_sold"], one["late_orders_count"], one["avg_review_score"]) == (35.0, 3, 2, 3.0)
    none = A.seller_performance(items, orders, reviews.filter("false")).first()
    assert none["avg_review_score"] == 4.0 and none["total_revenue"] == 35.0


def test_retention_starts_at_100(spark):
    rows = [(1, "2017-01-05"), (1, "2017-03-01"), (2, "2017-01-20"), (3, "2017-02-02")]
    orders = spark.createDataFrame([(i, c, dt.datetime.fromisoformat(d)) for i, (c, d) in enumerate(rows)], "order_id long, customer_id long, order_purchase_timestamp timestamp")
    people = spark.createDataFrame([(i, i) for i in (1, 2, 3)], "customer_id long, customer_unique_id long")
    assert A.cohort_span(orders) == 2
    got = {r["cohort_month"]: list(r)[1:] for r in A.cohort_retention_pct(A.cohort_matrix(people, orders, 2)).collect()}
    assert got == {"2017-01": [100.0, 0.0, 50.0], "2017-02": [100.0, 0.0, 0.0]}


def test_profile_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), (None, None), ("a", 4.0), ("b", 4.0)], "c string, x double")
    got = R.categorical_statistics(df).first()
    assert (got["unique_count"], got["top_value"], got["top_frequency"], got["top_percent"], got["null_count"]) == (2, "a", 2, 40.0, 1)
    assert R.duplicates(df.union(df), ["c"]).first()["exact_duplicate_rows"] == 5
    h = R.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in h] == [1, 1, 2]


@pytest.mark.parametrize("n", [1, 2])
def test_skewness_of_tiny_samples_is_zero(spark, n):
    from marketlens.functions.ordering import describe

    df = spark.range(n).select(F.col("id").cast("double").alias("v"))
    assert describe(df, "v").first()["skewness"] == 0.0


def test_only_rows_of_repeated_keys_are_compared_whole(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "a"), (3, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    got = R.duplicates(df, ["k"]).first().asDict()
    assert (got["total_rows"], got["exact_duplicate_rows"], got["key_duplicate_rows"]) == (7, 2, 3)
    plain = R.duplicates(df).first().asDict()
    assert {k: v for k, v in plain.items() if k != "key_duplicate_rows"} == {k: v for k, v in got.items() if k != "key_duplicate_rows"}
    plan = R.duplicates(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_a_batch_of_profiles_reads_each_table_once(spark):
    df = spark.createDataFrame([(i, "x" * (60 + i % 9), i / 2) for i in range(50)], "k long, t string, v double")
    got = R.profile_batch({"one": df.join(df.select("k"), "k"), "two": df}, {"one": ["k"]})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # all is written; nothing is left to compute
    alone = R.profile_report("two", df)
    assert sorted(map(tuple, got.filter("dataset = 'two'").collect())) == sorted(map(tuple, alone.collect()))
