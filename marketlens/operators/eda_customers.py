"""Customer reports: geography, growth, repeat rate, frequency, spend and value tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl, money, pct, year_month
from marketlens.functions.ordering import describe, weighted_quantiles
from marketlens.operators.reporting import by_sections, rounded_stats, top_rows, with_all_labels
from marketlens.sources.workspace import stored

VALUE_TIERS = ["Low Value (Bottom 25%)", "Medium Value (25%-75%)", "High Value (Top 25%)"]
FREQUENCY_TIERS = ["One-time", "Occasional (2-5 orders)", "Frequent (>5 orders)"]


def customer_geography(customers: DataFrame, top_cities: int = 20) -> DataFrame:
    """Customers by state, the largest cities, and the number of cities: (section, key, n)."""
    places = customers.groupBy("customer_state", "customer_city").agg(F.count(F.lit(1)).alias("n"))
    per_place = by_sections(
        places, {"state": F.col("customer_state"), "city": F.col("customer_city")}, [F.sum("n").alias("n")]
    )
    cities = per_place.filter("section = 'city'")
    top = top_rows(cities, "city", [F.col("n").desc(), F.col("key")], top_cities).select(
        F.lit("top_city").alias("section"), "key", "n"
    )
    number = cities.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("total").alias("section"), F.lit("cities").alias("key"), "n"
    )
    return per_place.filter("section = 'state'").unionByName(top).unionByName(number)


def customer_growth(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Persons by year and month of their first purchase; never-buyers are left out."""
    per_customer = orders.groupBy("customer_id").agg(F.min("order_purchase_timestamp").alias("first"))
    first = (
        customers.select("customer_id", "customer_unique_id")
        .join(per_customer, "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.min("first").alias("first"))
    )
    months = first.groupBy(year_month("first").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return by_sections(months, {"year": F.substring("month", 1, 4), "month": F.col("month")}, [F.sum("n").alias("customers")])


def person_totals(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders and spend per person; persons without orders have zeros.

    Orders are reduced per customer id before the join, so an id that holds a large share of
    them is combined on the map side. An order has one customer: the distinct counts add up.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"), F.sum(money("order_value")).alias("spend")
    )
    return (
        customers.select("customer_id", "customer_unique_id")
        .join(per_customer, "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
            money(F.coalesce(F.sum("spend"), F.lit(0))).alias("spend"),
        )
    )


def repeat_rate(totals: DataFrame) -> DataFrame:
    repeat = count_if(F.col("orders") > 1)
    people = F.count(F.lit(1))
    return totals.agg(
        people.alias("total_unique_customers"),
        repeat.alias("repeat_customers"),
        pct(repeat, people).alias("repeat_purchase_rate_percent"),
    )


def order_frequency_stats(totals: DataFrame) -> DataFrame:
    return rounded_stats(describe(totals, "orders")).drop("skewness", "null_count")


def order_frequency_histogram(totals: DataFrame) -> DataFrame:
    return totals.groupBy("orders").agg(F.count(F.lit(1)).alias("customers"))


def spend_stats(totals: DataFrame) -> DataFrame:
    d = describe(totals, "spend")
    return rounded_stats(d.withColumn("total", F.round("total", 2)), keep=["n", "total"]).drop("std", "skewness")


def _tiers(tagged: DataFrame, labels: list[str]) -> DataFrame:
    """Share of persons and revenue per tier. ``tagged`` has tier, people, spend."""
    per_tier = tagged.groupBy("tier").agg(F.sum("people").alias("people"), F.sum("spend").alias("spend"))
    whole = per_tier.agg(F.sum("people").alias("all_people"), F.sum("spend").alias("all_spend"))
    full = with_all_labels(per_tier, "tier", labels).crossJoin(F.broadcast(whole))  # three rows, one row
    return full.select(
        "tier",
        F.col("people").alias("customer_count"),
        F.round(dbl("spend"), 2).alias("revenue_contribution"),
        pct(F.col("people"), F.col("all_people")).alias("customer_percentage"),
        pct(F.col("spend"), F.col("all_spend")).alias("revenue_percentage"),
    )


def value_tiers(totals: DataFrame) -> DataFrame:
    """Tiers at the first and third quartile of spend (each tier includes its upper edge)."""
    counts = stored(totals.groupBy("spend").agg(F.count(F.lit(1)).alias("people")), "spend")
    q = weighted_quantiles(counts, "spend", "people", {"q25": 0.25, "q75": 0.75})
    s = dbl("spend")
    tier = F.when(s <= F.col("q25"), VALUE_TIERS[0]).when(s <= F.col("q75"), VALUE_TIERS[1]).otherwise(VALUE_TIERS[2])
    tagged = counts.crossJoin(F.broadcast(q)).select(  # one row of quartiles
        tier.alias("tier"), "people", (F.col("spend") * F.col("people")).alias("spend")
    )
    return _tiers(tagged, VALUE_TIERS)


def frequency_tiers(totals: DataFrame) -> DataFrame:
    n = F.col("orders")
    tier = F.when(n == 1, FREQUENCY_TIERS[0]).when((n >= 2) & (n <= 5), FREQUENCY_TIERS[1]).when(n > 5, FREQUENCY_TIERS[2])
    # Persons without orders belong to no tier but count in the percentages.
    tagged = totals.groupBy(F.coalesce(tier, F.lit("none")).alias("tier")).agg(
        F.count(F.lit(1)).alias("people"), F.sum("spend").alias("spend")
    )
    return _tiers(tagged, FREQUENCY_TIERS)
