"""Headline figures composed from the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl, money, pct, ratio, total
from marketlens.operators.eda_delivery import arrived, state_ranking
from marketlens.operators.eda_sales import monthly_totals


def executive(orders: DataFrame, customers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders, customers, value, review score and on-time rate. One row."""
    done = F.col("order_delivered_customer_date").isNotNull()
    s = F.col("review_score")
    one = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        total(money("order_value")).alias("value"),
        count_if(done & (F.col("delivery_delay_days") <= 0)).alias("on_time"),
        count_if(done).alias("delivered"),
    )
    people = customers.agg(F.count(F.lit(1)).alias("total_customers"))
    scores = reviews.agg(F.round(ratio(F.sum(s), F.count(s)), 2).alias("average_review_score"))
    return one.crossJoin(F.broadcast(people)).crossJoin(F.broadcast(scores)).select(  # one-row frames
        "total_orders",
        "total_customers",
        F.round(ratio(F.col("value"), F.col("total_orders")), 2).alias("average_order_value"),
        F.round(dbl("value"), 2).alias("total_revenue"),
        "average_review_score",
        pct(F.col("on_time"), F.col("delivered")).alias("sla_percent"),
    )


def monthly_cumulative(orders: DataFrame) -> DataFrame:
    running = F.sum("revenue").over(Window.orderBy("year_month"))  # one row per month
    return monthly_totals(orders).select(
        "year_month", F.round(dbl("revenue"), 2).alias("net_revenue"), F.round(dbl(running), 2).alias("cumulative_revenue")
    )


def delivery(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean delivery days, late rate, and mean score of late and on-time deliveries. One row."""
    per_order = reviews.groupBy("order_id").agg(F.sum("review_score").alias("score"), F.count("review_score").alias("n"))
    late, on_time = F.col("delivery_delay_days") > 0, F.col("delivery_delay_days") <= 0
    rows = arrived(orders).join(per_order, "order_id", "left")
    days = money("delivery_days")

    def score_of(c):
        return F.round(ratio(F.sum(F.when(c, F.col("score"))), F.sum(F.when(c, F.col("n"))), None), 2)

    return rows.agg(
        F.round(ratio(F.sum(days), F.count(days)), 2).alias("average_delivery_days"),
        pct(count_if(late), F.count(F.lit(1))).alias("late_delivery_rate_pct"),
        score_of(on_time).alias("on_time_avg_score"),
        score_of(late).alias("late_avg_score"),
    )


def delivery_states(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return state_ranking(orders, customers, 10)


