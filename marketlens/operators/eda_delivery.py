"""Delivery reports over orders with durations and item totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import (
    count_if,
    days_between,
    dbl,
    money,
    money_mean,
    pct,
    right_closed_bucket,
)
from marketlens.functions.ordering import describe
from marketlens.operators.reporting import rounded_stats, top_rows, with_all_labels

DELIVERY_EDGES = [(3, "0-3 days"), (7, "4-7 days"), (14, "8-14 days"), (21, "15-21 days"), (30, "22-30 days")]
DELIVERY_LAST = ">30 days"
DELAY_EDGES = [(-10, ">10 days early"), (0, "0-10 days early"), (5, "1-5 days late"), (10, "6-10 days late")]
DELAY_LAST = ">10 days late"


def labels(edges: list[tuple[float, str]], last: str) -> list[str]:
    return [label for _, label in edges] + [last]


def delivery_bucket() -> Column:
    return right_closed_bucket(F.col("delivery_days"), DELIVERY_EDGES, DELIVERY_LAST)


def delay_bucket() -> Column:
    return right_closed_bucket(F.col("delivery_delay_days"), DELAY_EDGES, DELAY_LAST)


def arrived(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_delivered_customer_date").isNotNull())


def stage_durations(orders: DataFrame) -> DataFrame:
    """Days spent in approval, dispatch, transit, delivery, and past the estimate, per order."""
    p, a, c, d, e = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return orders.select(
        "order_id",
        days_between(a, p).alias("approval_days"),
        days_between(c, a).alias("dispatch_days"),
        days_between(d, c).alias("transit_days"),
        days_between(d, p).alias("delivery_days"),
        days_between(d, e).alias("delay_days"),
    )


def _day_stats(orders: DataFrame, column: str) -> DataFrame:
    # Durations carry two decimals; as decimals their mean does not depend on task order.
    return describe(arrived(orders).select(money(column).alias("days")), "days")


def delivery_stats(orders: DataFrame) -> DataFrame:
    return rounded_stats(_day_stats(orders, "delivery_days")).drop("std", "skewness", "null_count")


def delay_stats(orders: DataFrame) -> DataFrame:
    return rounded_stats(_day_stats(orders, "delivery_delay_days")).drop("null_count")


def _bucket_counts(orders: DataFrame, bucket: Column, names: list[str]) -> DataFrame:
    """Count and share of delivered orders per bucket; empty buckets appear with 0."""
    counts = arrived(orders).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("all_n"))  # includes orders without a duration
    full = with_all_labels(counts.filter(F.col("bucket").isNotNull()), "bucket", names)
    return full.crossJoin(F.broadcast(whole)).select(  # one row
        "bucket", F.col("n").alias("count"), pct(F.col("n"), F.col("all_n")).alias("percentage")
    )


def delivery_buckets(orders: DataFrame) -> DataFrame:
    return _bucket_counts(orders, delivery_bucket(), labels(DELIVERY_EDGES, DELIVERY_LAST))


def delay_buckets(orders: DataFrame) -> DataFrame:
    return _bucket_counts(orders, delay_bucket(), labels(DELAY_EDGES, DELAY_LAST))


def delay_summary(orders: DataFrame) -> DataFrame:
    delay, n = F.col("delivery_delay_days"), F.count(F.lit(1))
    late, early, on_time = delay > 0, delay < 0, delay <= 0

    def mean_of(condition: Column) -> Column:
        return F.round(F.coalesce(F.abs(money_mean(F.when(condition, money(delay)))), F.lit(0.0)), 2)

    return arrived(orders).agg(
        n.alias("delivered"),
        count_if(late).alias("late_count"),
        pct(count_if(late), n).alias("late_percentage"),
        mean_of(late).alias("average_days_late"),
        count_if(early).alias("early_count"),
        pct(count_if(early), n).alias("early_percentage"),
        mean_of(early).alias("average_days_early"),
        count_if(on_time).alias("on_time_count"),
        pct(count_if(on_time), n).alias("on_time_percentage"),
    )


def _with_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return arrived(orders).join(customers.select("customer_id", "customer_state"), "customer_id")


def state_delivery(orders: DataFrame, customers: DataFrame) -> DataFrame:
    late = count_if(F.col("is_late_delivery"))
    return (
        _with_state(orders, customers)
        .groupBy("customer_state")
        .agg(
            F.round(money_mean("delivery_days"), 2).alias("average_delivery_days"),
            F.round(money_mean("delivery_delay_days"), 2).alias("average_delay_days"),
            pct(late, F.count("is_late_delivery")).alias("late_delivery_rate"),
            F.count("order_id").alias("order_count"),
        )
    )


def state_ranking(orders: DataFrame, customers: DataFrame, n: int = 20) -> DataFrame:
    """The n fastest and n slowest states by mean delivery days."""
    states = state_delivery(orders, customers)
    days, state = F.col("average_delivery_days"), F.col("customer_state")
    fastest = top_rows(states, "fastest", [days.asc(), state], n)
    return fastest.unionByName(top_rows(states, "slowest", [days.desc(), state], n))


def freight_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean freight, and mean freight share of order value. Orders of zero value have no share."""
    share = F.try_divide(dbl("total_freight_value"), dbl("order_value")) * 100.0
    return (
        _with_state(orders, customers)
        .groupBy("customer_state")
        .agg(
            F.round(money_mean("total_freight_value"), 2).alias("average_freight"),
            F.round(F.avg(share), 2).alias("freight_percentage"),
        )
    )


def freight_delivery_correlation(orders: DataFrame) -> DataFrame:
    return arrived(orders).agg(
        F.round(F.corr(dbl("total_freight_value"), F.col("delivery_days")), 4).alias("freight_vs_delivery_days")
    )


def freight_distribution(orders: DataFrame) -> DataFrame:
    return rounded_stats(describe(orders, "total_freight_value"))


def delivery_operational(orders: DataFrame) -> DataFrame:
    """Mean stage times without negative ones, and the on-time rate."""
    stages = orders.select(
        days_between("order_approved_at", "order_purchase_timestamp").alias("approval_days"),
        days_between("order_delivered_carrier_date", "order_approved_at").alias("dispatch_days"),
        days_between("order_delivered_customer_date", "order_delivered_carrier_date").alias("transit_days"),
        F.col("order_delivered_customer_date").isNotNull().alias("done"),
        (F.col("delivery_delay_days") <= 0).alias("on_time"),
    )

    def mean_of(c: str) -> Column:
        return F.round(F.coalesce(F.avg(F.when(F.col(c) >= 0, F.col(c))), F.lit(0.0)), 2)

    return stages.agg(
        mean_of("approval_days").alias("average_order_processing_time_days"),
        mean_of("dispatch_days").alias("average_carrier_time_days"),
        mean_of("transit_days").alias("average_shipping_time_days"),
        pct(count_if(F.col("done") & F.col("on_time")), count_if(F.col("done"))).alias("delivery_sla_achievement_rate_percent"),
    )
