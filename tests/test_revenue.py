import datetime as dt
import re

from pyspark.sql import functions as F

from marketlens.functions import skew
from marketlens.operators import revenue as R


def frames(spark, orders, payments):
    rows = [(o, c, s, dt.datetime.fromisoformat(d)) for o, c, s, d in orders]
    return (
        spark.createDataFrame([("c1", "p", "SP"), ("c2", "p", "RJ")], "customer_id string, customer_unique_id string, customer_state string"),
        spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp"),
        spark.createDataFrame(payments, "order_id string, payment_value double"),
    )


def test_one_person_in_two_states_is_two_rows(spark):
    got = R.rfm_profile(
        *frames(
            spark,
            [("a", "c1", "delivered", "2017-01-01T12:00:00"), ("b", "c2", "delivered", "2017-06-01"), ("x", "c2", "canceled", "2017-07-01")],
            [("a", 10.0), ("a", 5.0), ("b", 7.0), ("x", 99.0)],
        )
    ).collect()
    by_state = {r["customer_state"]: r for r in got}
    assert (by_state["SP"]["monetary_value"], by_state["SP"]["avg_order_value"]) == (15.0, 7.5)  # mean per payment
    assert (by_state["SP"]["recency_days"], by_state["SP"]["recency_status"]) == (180, "At-Risk")  # 180.5 truncated
    assert (by_state["RJ"]["recency_days"], by_state["RJ"]["buyer_type"]) == (30, "One-Time Buyer")


def test_growth_after_a_zero_month_is_unknown(spark):
    out = R.monthly_growth(
        *frames(spark, [("a", "c1", "delivered", "2017-01-01"), ("b", "c1", "delivered", "2017-02-01")], [("a", 0.0), ("b", 5.0)])
    )
    got = {r["year_month"]: r for r in out.collect()}
    assert got["2017-01"]["mom_growth_pct"] == 0.0 and got["2017-02"]["mom_growth_pct"] is None
    assert got["2017-02"]["cumulative_revenue"] == 5.0


def test_seller_pareto_ties_and_zero_revenue(spark):
    sellers = spark.createDataFrame([(i, "SP") for i in range(6)], "seller_id long, seller_state string")
    orders = spark.createDataFrame([("o", "delivered")], "order_id string, order_status string")

    def run(prices):
        items = spark.createDataFrame([("o", i, float(p)) for i, p in enumerate(prices)], "order_id string, seller_id long, price double")
        return R.seller_pareto(items, sellers, orders).orderBy("seller_rank").collect()

    tied = run([10] * 5)
    assert [r["seller_id"] for r in tied] == [0, 1, 2, 3, 4]
    assert [r["pareto_tier"][:3] for r in tied] == ["Top", "Top", "Top", "Top", "Lon"]  # exactly 80 % is still top
    zero = run([0, 0])
    assert {r["pareto_tier"] for r in zero} == {"Long-Tail Contributor"}
    assert {r["cumulative_revenue_pct"] for r in zero} == {None}


def test_seller_pareto_tasks_grow_with_the_items(spark, monkeypatch):
    sellers = spark.createDataFrame([(i, "SP") for i in range(7)], "seller_id long, seller_state string")
    orders = spark.range(500).select(F.col("id").alias("order_id"), F.when(F.col("id") % 3 > 0, "delivered").otherwise("shipped").alias("order_status"))
    # Two items of each order share a seller; some have no order.
    items = spark.range(2000).select(
        F.when(F.col("id") < 1900, F.col("id") % 500).alias("order_id"), (F.col("id") % 250 % 7).alias("seller_id"), (F.col("id") % 90).cast("double").alias("price")
    )
    plans, rank = [], R.rank_rows

    def watched(rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rank(rows, *rest)

    monkeypatch.setattr(R, "rank_rows", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = R.seller_pareto(items, sellers, orders).collect()
        monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
        many = R.seller_pareto(items, sellers, orders).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    numbers = [set(re.findall(r"hashpartitioning\(order_id#\d+L?, (\d+)\)", plan)) for plan in plans]
    assert numbers == [{"4"}, {"20"}]
    assert sorted(few) == sorted(many) and len(few) == 7
    done = [(i % 500, i % 250 % 7) for i in range(1900) if i % 500 % 3 > 0]
    assert {r["seller_id"]: r["total_orders_handled"] for r in many} == {s: len({o for o, t in done if t == s}) for s in range(7)}
