"""Cohort matrices, seller performance, Pareto shares, order status audit."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import days_between, dbl, money, money_total, pct, ratio, total
from marketlens.model import ORDER_STATUSES
from marketlens.operators.eda_sales import top_share
from marketlens.operators.revenue import cohort_counts


def cohort_matrix(customers: DataFrame, orders: DataFrame, months: int) -> DataFrame:
    """Active persons, cohort by month index 0..months, all order statuses, absent cells 0."""
    counts = cohort_counts(customers, orders)
    wide = counts.groupBy("cohort_month").pivot("month_number", list(range(months + 1))).agg(F.sum("active_customers"))
    named = wide.withColumnsRenamed({str(i): f"m{i}" for i in range(months + 1)})
    return named.fillna(0)


def cohort_span(orders: DataFrame) -> int:
    """Months from the first to the last purchase: the largest index a matrix can need."""
    ts = F.col("order_purchase_timestamp")
    row = orders.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
    return (row["b"].year - row["a"].year) * 12 + row["b"].month - row["a"].month if row["a"] else 0


def cohort_retention_pct(matrix: DataFrame) -> DataFrame:
    """Each cell over the cohort's month 0, in percent with two decimals."""
    cells = [c for c in matrix.columns if c != "cohort_month"]
    return matrix.select(
        "cohort_month", *[F.round(F.round(ratio(F.col(c), F.col("m0")), 4) * 100.0, 2).alias(c) for c in cells]
    )


def _order_delay(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", days_between("order_delivered_customer_date", "order_estimated_delivery_date").alias("delay_days")
    )


def _seller_metrics(rows: DataFrame) -> DataFrame:
    """``rows``: one row per seller, order and product with item counts and the copies of each item."""
    sums = rows.groupBy("seller_id").agg(
        F.sum("price").alias("revenue"),
        F.sum("freight").alias("freight"),
        F.sum("items").alias("items"),
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("product_id").alias("unique_products"),
        F.sum("delay_sum").alias("delay_sum"),
        F.sum("delay_rows").alias("delay_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_rows").alias("score_rows"),
    )
    return sums.select(
        "seller_id",
        F.round(dbl("revenue"), 2).alias("total_revenue"),
        F.col("items").alias("total_items_sold"),
        "total_orders",
        "unique_products",
        F.round(dbl("revenue") / F.col("items"), 2).alias("avg_item_price"),
        F.round(dbl("freight") / F.col("items"), 2).alias("avg_freight"),
        F.round(ratio(F.col("delay_sum"), F.col("delay_rows")), 2).alias("avg_delivery_delay"),
        F.col("late_rows").alias("late_orders_count"),
        F.round(F.when(F.col("score_rows") > 0, F.col("score_sum") / F.col("score_rows")).otherwise(4.0), 2).alias("avg_review_score"),
        F.round(ratio(F.col("late_rows"), F.col("total_orders")), 4).alias("late_delivery_rate"),
    )


def _seller_rows(items: DataFrame, orders: DataFrame, per_order_reviews: DataFrame) -> DataFrame:
    """Items reduced to (seller, order, product), then joined to one row per order.

    ``copies`` is how often the join with reviews would repeat each item; multiplying by it
    gives the fan-out result without building the fan-out.
    """
    reduced = items.groupBy("seller_id", "order_id", "product_id").agg(
        F.count("order_item_id").alias("n"), F.sum(money("price")).alias("price"), F.sum(money("freight_value")).alias("freight")
    )
    joined = reduced.join(_order_delay(orders), "order_id", "left").join(per_order_reviews, "order_id", "left")
    copies = F.coalesce("copies", F.lit(1))
    times = F.col("n") * copies
    return joined.select(
        "seller_id",
        "order_id",
        "product_id",
        (F.col("price") * copies).alias("price"),
        (F.col("freight") * copies).alias("freight"),
        times.alias("items"),
        (F.col("delay_days") * times).alias("delay_sum"),
        F.when(F.col("delay_days").isNotNull(), times).otherwise(0).alias("delay_rows"),
        F.when(F.col("delay_days") > 0, times).otherwise(0).alias("late_rows"),
        (F.col("score_sum") * F.col("n")).alias("score_sum"),
        (F.col("score_rows") * F.col("n")).alias("score_rows"),
    )


def seller_performance(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Nine metrics per seller over items x reviews: an order with two reviews counts its items twice."""
    s = F.col("review_score")
    per_order = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum(s).cast("double").alias("score_sum"), F.count(s).alias("score_rows")
    )
    return _seller_metrics(_seller_rows(items, orders, per_order))


def seller_performance_dedup(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """As ``seller_performance`` with reviews averaged per order first, so nothing is repeated."""
    per_order = reviews.groupBy("order_id").agg(
        F.lit(1).alias("copies"),
        F.avg("review_score").alias("score_sum"),
        F.when(F.count("review_score") > 0, 1).otherwise(0).alias("score_rows"),
    )
    return _seller_metrics(_seller_rows(items, orders, per_order))


def _pareto_cuts() -> dict[str, Column]:
    """k = the largest count whose share of all entities is at most p percent."""
    return {f"top_{p}_percent_revenue_share": F.floor(F.col("total_n") * p / 100) for p in (10, 20, 50)}


def pareto_customers(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_id").agg(F.sum(money("price")).alias("price"))
    per_customer = (
        orders.select("order_id", "customer_id")
        .join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(total("price").alias("revenue"))
    )
    revenue = (
        per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return top_share(revenue, "revenue", _pareto_cuts()).withColumnsRenamed(
        {"entities": "total_customers", "total_value": "total_revenue"}
    )


def pareto_sellers(items: DataFrame) -> DataFrame:
    revenue = items.groupBy("seller_id").agg(F.sum(money("price")).alias("revenue"))
    return top_share(revenue, "revenue", _pareto_cuts()).withColumnsRenamed(
        {"entities": "total_sellers", "total_value": "total_revenue"}
    )


def order_status_audit(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row: orders by status and value by outcome. The rate counts unavailable as cancelled."""
    per_order = payments.groupBy("order_id").agg(F.sum(money("payment_value")).alias("paid"))
    by_status = (
        orders.select("order_id", "order_status")
        .join(per_order, "order_id", "left")
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("n"), total("paid").alias("paid"))
    )
    status = F.col("order_status")
    lost, done = status.isin("canceled", "unavailable"), status == "delivered"
    flight = ~F.coalesce(lost | done, F.lit(False))

    def orders_of(c: Column) -> Column:
        return total(F.when(c, F.col("n")))

    return by_status.agg(
        total("n").alias("total_orders"),
        *[orders_of(status == s).alias(f"{s}_orders") for s in ORDER_STATUSES],
        money_total("paid").alias("gross_gmv_all_orders"),
        money_total(F.when(done, F.col("paid"))).alias("net_delivered_revenue"),
        money_total(F.when(lost, F.col("paid"))).alias("lost_canceled_revenue"),
        money_total(F.when(flight, F.col("paid"))).alias("in_flight_revenue"),
        pct(orders_of(lost), total("n")).alias("cancellation_rate_pct"),
    )
