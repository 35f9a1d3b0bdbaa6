"""The three hypothesis tests of the analytics library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import days_between, dbl, money, total
from marketlens.functions.rank_tests import kruskal_wallis, mann_whitney
from marketlens.functions.skew import join_by_frequency

# The five states compared by default.
TOP_STATES = ["SP", "RJ", "MG", "RS", "PR"]


def _delays(orders: DataFrame) -> DataFrame:
    delay = days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.select("order_id", "customer_id", delay.alias("delay_days")).filter(F.col("delay_days").isNotNull())


def delay_against_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Are review scores of late deliveries lower than those of on-time ones?"""
    rows = _delays(orders).join(reviews.select("order_id", "review_score"), "order_id")
    out = mann_whitney(rows, "review_score", F.col("delay_days") > 0, "less")
    return out.withColumnsRenamed({"n1": "late_orders", "n2": "ontime_orders", "mean1": "late_mean", "mean2": "ontime_mean"})


def repeat_against_single_spend(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Does the average order spend of repeat buyers differ from that of single buyers?"""
    per_order = items.groupBy("order_id").agg(F.sum(money("price")).alias("price"))
    per_customer = (
        orders.select("order_id", "customer_id")
        .join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(F.countDistinct("order_id").alias("orders"), total("price").alias("price"), F.count(F.lit(1)).alias("rows"))
    )
    people = (
        per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("orders").alias("orders"), (dbl(F.sum("price")) / F.sum("rows")).alias("spend"))
    )
    out = mann_whitney(people, "spend", F.col("orders") > 1)
    return out.withColumnsRenamed(
        {"n1": "repeat_buyers", "n2": "single_buyers", "mean1": "repeat_mean_aov", "mean2": "single_mean_aov"}
    )


def state_delays(customers: DataFrame, orders: DataFrame, states: Sequence[str] = tuple(TOP_STATES)) -> DataFrame:
    """Does the delivery delay differ between the given states?"""
    delays = _delays(orders).select("customer_id", "delay_days")
    rows = join_by_frequency(delays, customers.select("customer_id", "customer_state"), "customer_id")
    return kruskal_wallis(rows, "delay_days", "customer_state", list(states))
