"""The SQL report family: RFM, monthly growth, cohorts, seller Pareto, SLA, status audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import (
    MICROS_PER_DAY,
    count_if,
    days_between,
    dbl,
    money,
    money_total,
    pct,
    year_month,
)
from marketlens.functions.ordering import ntile, rank_rows
from marketlens.functions.skew import dealt_by
from marketlens.sources.workspace import stored

def delivered() -> Column:
    return F.col("order_status") == "delivered"


MIN_STATE_ORDERS = 100


def rfm_profile(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Recency, frequency, monetary value per person and state, over delivered orders.

    The reference date is the last purchase over all orders. Payments are summed per order
    before they meet the orders, and orders per customer id before they meet the persons: a key
    that holds a large share of the rows is combined on the map side, ahead of any join.
    """
    per_order = payments.groupBy("order_id").agg(
        F.sum(money("payment_value")).alias("paid"), F.count("payment_value").alias("paid_rows")
    )
    per_customer = (
        orders.filter(delivered())
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.max("order_purchase_timestamp").alias("last"),
            F.sum("paid").alias("paid"),
            F.sum("paid_rows").alias("paid_rows"),
        )
    )
    per_person = (
        per_customer.join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .groupBy("customer_unique_id", "customer_state")
        .agg(
            F.sum("orders").alias("frequency"),
            F.max("last").alias("last_purchase"),
            F.sum("paid").alias("monetary"),
            F.sum("paid_rows").alias("paid_rows"),
        )
    )
    reference = orders.agg(F.max("order_purchase_timestamp").alias("reference"))  # one row
    recency = F.floor(days_between("reference", "last_purchase")).cast("long")
    return per_person.crossJoin(F.broadcast(reference)).select(
        "customer_unique_id",
        "customer_state",
        recency.alias("recency_days"),
        "frequency",
        F.round(dbl("monetary"), 2).alias("monetary_value"),
        F.round(dbl("monetary") / F.col("paid_rows"), 2).alias("avg_order_value"),
        F.when(recency <= 90, "Active").when(recency <= 180, "At-Risk").otherwise("Dormant").alias("recency_status"),
        F.when(F.col("frequency") > 1, "Repeat Buyer").otherwise("One-Time Buyer").alias("buyer_type"),
    )


def rfm_quantile_scores(rfm: DataFrame) -> DataFrame:
    """NTILE(5) scores: 5 is most recent, most frequent, highest value. One row per person."""
    people = stored(
        rfm.groupBy("customer_unique_id").agg(
            F.min("recency_days").alias("recency_days"),
            F.sum("frequency").alias("frequency"),
            money(F.sum(money("monetary_value"))).alias("monetary_value"),
        ),
        "people",
    )
    out = people
    for value, score, descending in (
        ("recency_days", "r_score", True),
        ("frequency", "f_score", False),
        ("monetary_value", "m_score", False),
    ):
        ranked = rank_rows(people.select("customer_unique_id", value), value, "customer_unique_id", descending)
        tiles = ranked.select("customer_unique_id", ntile(F.col("row_number"), F.col("total_n"), 5).alias(score))
        out = out.join(tiles, "customer_unique_id")
    return out.withColumn("monetary_value", dbl("monetary_value"))


def monthly_growth(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Revenue per month, month-over-month growth, running total; delivered orders."""
    per_order = payments.groupBy("order_id").agg(
        F.sum(money("payment_value")).alias("paid"), F.count("payment_value").alias("paid_rows")
    )
    # Month and customer first: one distinct count remains, so the rows are not expanded for two.
    per_customer = (
        orders.filter(delivered())
        .select("order_id", "customer_id", year_month("order_purchase_timestamp").alias("year_month"))
        .join(per_order, "order_id")
        .groupBy("year_month", "customer_id")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.sum("paid").alias("paid"),
            F.sum("paid_rows").alias("paid_rows"),
        )
    )
    per_person = (
        per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("year_month", "customer_unique_id")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "paid", "paid_rows")])
    )
    monthly = per_person.groupBy("year_month").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_unique_id").alias("unique_buyers"),
        F.sum("paid").alias("exact"),
        (dbl(F.sum("paid")) / F.sum("paid_rows")).alias("aov"),
    )
    by_month = Window.orderBy("year_month")  # one row per calendar month
    previous = dbl(F.lag("exact").over(by_month))
    running = F.sum("exact").over(by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return monthly.select(
        "year_month",
        "total_orders",
        "unique_buyers",
        F.round(dbl("exact"), 2).alias("monthly_revenue"),
        F.round("aov", 2).alias("monthly_aov"),
        F.round(dbl(running), 2).alias("cumulative_revenue"),
        F.round(
            F.when(previous.isNull(), F.lit(0.0)).otherwise(F.try_divide(dbl("exact") - previous, previous) * 100.0), 2
        ).alias("mom_growth_pct"),
    )


def person_months(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person and active month, with the months since the person's first."""
    per_customer = (
        orders.filter(F.col("order_purchase_timestamp").isNotNull())
        .groupBy("customer_id", F.trunc("order_purchase_timestamp", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    active = (
        per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id", "month")
        .agg(F.sum("orders").alias("orders"))
    )
    # At most one row per calendar month in a person's partition.
    first = F.min("month").over(Window.partitionBy("customer_unique_id"))
    months = (F.year("month") - F.year(first)) * 12 + F.month("month") - F.month(first)
    return active.select(
        "customer_unique_id", F.date_format(first, "yyyy-MM").alias("cohort_month"), months.cast("long").alias("month_number")
    )


def cohort_counts(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Active persons per cohort and month; person-months are distinct, so a count is exact."""
    return person_months(customers, orders).groupBy("cohort_month", "month_number").agg(
        F.count(F.lit(1)).alias("active_customers")
    )


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Long-form retention over delivered orders."""
    counts = cohort_counts(customers, orders.filter(delivered()))
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return counts.select(
        "cohort_month",
        size.alias("initial_cohort_size"),
        "month_number",
        "active_customers",
        F.round(dbl("active_customers") / size * 100.0, 2).alias("retention_pct"),
    )


def seller_pareto(order_items: DataFrame, sellers: DataFrame, orders: DataFrame) -> DataFrame:
    """Sellers by delivered revenue with cumulative shares; the one that crosses 80 % is long tail."""
    done = orders.filter(delivered()).select("order_id")
    items, done = dealt_by(order_items.select("order_id", "seller_id", "price"), done, "order_id")
    # Seller and order first, so an order's items meet before the distinct count is needed.
    per_order = (
        items.join(done, "order_id", "left_semi")
        .groupBy("seller_id", "order_id")
        .agg(F.sum(money("price")).alias("price"))
    )
    revenue = per_order.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_orders_handled"), money(F.sum("price")).alias("revenue")
    )
    rows = revenue.join(sellers.select("seller_id", "seller_state"), "seller_id")
    ranked = rank_rows(rows, "revenue", "seller_id")
    share = F.try_divide(dbl(F.col("before_value") + F.col("revenue")), dbl("total_value"))
    return ranked.select(
        "seller_id",
        "seller_state",
        F.col("row_number").alias("seller_rank"),
        "total_orders_handled",
        F.round(dbl("revenue"), 2).alias("total_seller_revenue"),
        F.round(dbl("row_number") / F.col("total_n") * 100.0, 2).alias("cumulative_seller_pct"),
        F.round(share * 100.0, 2).alias("cumulative_revenue_pct"),
        F.when(share <= 0.80, "Top 80% Revenue Driver").otherwise("Long-Tail Contributor").alias("pareto_tier"),
    )


def state_sla(customers: DataFrame, orders: DataFrame, min_orders: int = MIN_STATE_ORDERS) -> DataFrame:
    """Delivery speed and on-time rate by state, for states with enough delivered orders."""
    arrived, due, bought = (F.col(c) for c in ("order_delivered_customer_date", "order_estimated_delivery_date", "order_purchase_timestamp"))

    def micros(start: Column) -> Column:
        return F.timestamp_diff("MICROSECOND", start, arrived).cast("decimal(38,0)")

    def mean_days(name: str) -> Column:
        return F.round(F.try_divide(dbl(F.sum(f"{name}_sum")), F.sum(f"{name}_n")) / MICROS_PER_DAY, 1)

    # Per customer first, whose orders combine on the map side: a hot customer is one row in the join.
    per_customer = (
        orders.filter(delivered() & arrived.isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum(micros(bought)).alias("taken_sum"),
            F.count(bought).alias("taken_n"),
            F.sum(micros(due)).alias("delay_sum"),
            F.count(due).alias("delay_n"),
            count_if(arrived > due).alias("late"),
            count_if(arrived <= due).alias("punctual"),
        )
    )
    states = (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("total_delivered_orders"),
            mean_days("taken").alias("avg_delivery_days"),
            mean_days("delay").alias("avg_delay_days"),
            F.sum("late").alias("late_deliveries_count"),
            F.sum("punctual").alias("ontime"),
        )
        .filter(F.col("total_delivered_orders") >= min_orders)
    )
    on_time = dbl("ontime") / F.col("total_delivered_orders")
    # One row per state from here on.
    return states.select(
        "customer_state",
        "total_delivered_orders",
        "avg_delivery_days",
        "avg_delay_days",
        "late_deliveries_count",
        F.round(on_time * 100.0, 2).alias("sla_achievement_rate_pct"),
        F.row_number().over(Window.orderBy(on_time.desc(), "customer_state")).cast("long").alias("sla_rank_best_to_worst"),
        F.ntile(4).over(Window.orderBy("avg_delivery_days", "customer_state")).cast("long").alias("speed_quartile"),
    )


def status_aggregates(orders: DataFrame, payments: DataFrame) -> DataFrame:
    per_order = payments.groupBy("order_id").agg(F.sum(money("payment_value")).alias("paid"))
    return (
        orders.select("order_id", "customer_id", "order_status")
        .join(per_order, "order_id", "left")
        .groupBy("order_status")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.round(dbl(F.sum("paid")), 2).alias("gross_payment_value"),
        )
    )


def revenue_reconciliation(statuses: DataFrame) -> DataFrame:
    """One row from ``status_aggregates``. The *_count columns count status groups, as the report does."""
    status, gross = F.col("order_status"), money("gross_payment_value")
    lost = status.isin("canceled", "unavailable")
    done = status == "delivered"

    def part(condition):
        return money_total(F.when(condition, gross))

    return statuses.agg(
        money_total(gross).alias("gross_gmv_all_orders"),
        part(done).alias("net_delivered_revenue"),
        part(lost).alias("lost_canceled_revenue"),
        part(~done & ~lost).alias("in_flight_order_revenue"),
        count_if(done).alias("delivered_orders_count"),
        count_if(status == "canceled").alias("canceled_orders_count"),
        count_if(status == "unavailable").alias("unavailable_orders_count"),
        F.count(F.lit(1)).alias("total_order_records"),
    )


def state_cancellations(customers: DataFrame, orders: DataFrame, min_orders: int = MIN_STATE_ORDERS) -> DataFrame:
    status = F.col("order_status")
    states = (
        orders.select("order_id", "customer_id", "order_status")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.countDistinct("order_id").alias("state_total_orders"),
            count_if(status == "delivered").alias("state_delivered_orders"),
            count_if(status == "canceled").alias("state_canceled_orders"),
        )
        .withColumn("cancellation_rate_pct", pct(F.col("state_canceled_orders"), F.col("state_total_orders")))
        .filter(F.col("state_total_orders") >= min_orders)
    )
    risk = Window.orderBy(F.col("cancellation_rate_pct").desc(), "customer_state")  # one row per state
    return states.withColumn("cancellation_risk_rank", F.row_number().over(risk).cast("long"))
