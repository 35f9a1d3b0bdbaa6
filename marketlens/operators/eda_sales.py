"""Sales reports over orders that carry their item totals (see clean.item_rollup)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import dbl, money, money_total, pct, ratio, total, year_month
from marketlens.functions.ordering import describe, distinct_values, running_totals
from marketlens.operators.eda_products import category_rank
from marketlens.operators.reporting import by_sections, rounded_stats, top_rows

# Known shopping dates.
EVENT_DAYS = {
    "2016-11-25": "Black Friday 2016",
    "2017-11-24": "Black Friday 2017",
    "2017-11-25": "Black Friday 2017",
    "2017-11-27": "Cyber Monday",
    "2018-11-26": "Cyber Monday",
}
MONTHS = "January February March April May June July August September October November December".split()
WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
MIN_MONTH_ORDERS = 10


def pick(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def revenue_totals(orders: DataFrame) -> DataFrame:
    return orders.agg(
        money_total("order_value").alias("total_revenue"),
        money_total("total_items_price").alias("total_items_revenue"),
        money_total("total_freight_value").alias("total_freight_revenue"),
    )


def monthly_totals(orders: DataFrame) -> DataFrame:
    """Revenue and orders per calendar month; orders without a purchase date are left out."""
    return (
        orders.groupBy(year_month("order_purchase_timestamp").alias("year_month"))
        .agg(F.sum(money("order_value")).alias("revenue"), F.count("order_id").alias("orders"))
        .filter(F.col("year_month").isNotNull())
    )


def revenue_by_period(orders: DataFrame) -> DataFrame:
    month = F.col("year_month")
    year = F.substring(month, 1, 4)
    quarter = F.concat(year, F.lit("Q"), F.ceil(F.substring(month, 6, 2).cast("int") / 3).cast("string"))
    return by_sections(
        monthly_totals(orders), {"year": year, "quarter": quarter, "month": month}, [money_total("revenue").alias("revenue")]
    )


def revenue_growth(orders: DataFrame) -> DataFrame:
    """Month-over-month growth of revenue; 0 without a positive previous month."""
    current = F.round(dbl("revenue"), 2)
    previous = F.lag(current).over(Window.orderBy("year_month"))  # one row per month
    return monthly_totals(orders).select(
        "year_month",
        current.alias("revenue"),
        F.round(F.when(previous > 0, (current - previous) / previous * 100.0).otherwise(0.0), 2).alias("growth_pct"),
    )


def orders_by_time(orders: DataFrame) -> DataFrame:
    """Orders by year, month, weekday and hour, from one count per hour of the calendar."""
    ts = F.col("hour_start")
    hourly = orders.groupBy(F.date_trunc("hour", "order_purchase_timestamp").alias("hour_start")).agg(
        F.count("order_id").alias("orders")
    )
    return by_sections(
        hourly,
        {
            "year": F.year(ts).cast("string"),
            "month": year_month(ts),
            "weekday": pick(WEEKDAYS, F.weekday(ts)),
            "hour": F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lit(":00")),
        },
        [F.sum("orders").alias("orders")],
    )


def order_value_stats(orders: DataFrame) -> DataFrame:
    return rounded_stats(describe(orders, "order_value"))


def seasonality(orders: DataFrame) -> DataFrame:
    """Calendar months and quarters across all years."""
    m = F.substring("year_month", 6, 2).cast("int")
    return by_sections(
        monthly_totals(orders),
        {"month": pick(MONTHS, m - 1), "quarter": F.concat(F.lit("Q"), F.ceil(m / 3).cast("string"))},
        [
            money_total("revenue").alias("total_revenue"),
            F.round(dbl(F.sum("revenue")) / F.sum("orders"), 2).alias("average_revenue"),
            F.sum("orders").alias("order_count"),
        ],
    )


def daily_spikes(orders: DataFrame, n: int = 10) -> DataFrame:
    """The n best days against mean + 3 sigma of daily revenue."""
    daily = (
        orders.groupBy(F.date_format("order_purchase_timestamp", "yyyy-MM-dd").alias("date"))
        .agg(F.sum(money("order_value")).alias("revenue"), F.count("order_id").alias("daily_orders"))
        .filter(F.col("date").isNotNull())
    )
    level = daily.agg(
        (dbl(F.sum("revenue")) / F.count(F.lit(1))).alias("mean"),
        F.coalesce(F.stddev_samp(dbl("revenue")), F.lit(0.0)).alias("sigma"),
    )
    best = top_rows(daily, "spike", [F.col("revenue").desc(), F.col("date")], n)
    d_rev, threshold = F.round(dbl("revenue"), 2), F.col("mean") + 3.0 * F.col("sigma")
    known = None
    for day, label in EVENT_DAYS.items():
        known = F.when(F.col("date") == day, label) if known is None else known.when(F.col("date") == day, label)
    tag = known.when(d_rev >= threshold, "Statistical Spike (>3 Sigma)").otherwise("Standard Peak")
    return best.crossJoin(F.broadcast(level)).select(  # n rows, one row
        "rank",
        "date",
        d_rev.alias("daily_revenue"),
        "daily_orders",
        F.round(ratio(d_rev, F.col("mean")), 2).alias("revenue_multiplier_vs_avg"),
        tag.alias("event_context"),
        F.round("mean", 2).alias("average_daily_revenue"),
        F.round(threshold, 2).alias("spike_threshold_3_sigma"),
    )


def best_worst_months(orders: DataFrame, n: int = 5, min_orders: int = MIN_MONTH_ORDERS) -> DataFrame:
    """Top and bottom months by revenue among those with ``min_orders`` orders (all months if none has)."""
    monthly = monthly_totals(orders)
    enough = F.max(F.col("orders") >= min_orders).over(Window.partitionBy())  # one row per month
    valid = monthly.withColumn("_any", enough).filter((F.col("orders") >= min_orders) | ~F.col("_any")).drop("_any")
    best = top_rows(valid, "highest", [F.col("revenue").desc(), F.col("year_month")], n)
    worst = top_rows(valid, "lowest", [F.col("revenue").asc(), F.col("year_month")], n)
    return best.unionByName(worst).select(
        "ranking", "rank", "year_month", F.round(dbl("revenue"), 2).alias("revenue"), F.col("orders").alias("order_count")
    )


def best_categories(items: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    return category_rank(items, products).filter(F.col("revenue_rank") <= n)


def top_share(revenues: DataFrame, value: str, cuts: dict[str, Column]) -> DataFrame:
    """One row: revenue share of the k largest entities for each cut.

    ``revenues`` has one row per entity. Entities of equal revenue are interchangeable, so a
    running total over distinct values is enough: no row-level ranking. A cut is a column
    over ``total_n`` giving k; k = 0 gives null.
    """
    v = money(value)
    per_value = distinct_values(revenues.select(v.alias("v")), "v").withColumn("s", F.col("v") * F.col("n"))
    ranked = running_totals(per_value, [F.col("v").desc()], ["n", "s"])
    aggs = [F.max("total_n").alias("entities"), dbl(F.max("total_s")).alias("total_value")]
    for name, k in cuts.items():
        taken = F.greatest(F.lit(0), F.least(F.col("n"), k - F.col("before_n")))
        aggs.append(F.when(F.max(k) > 0, dbl(F.sum(F.col("v") * taken))).alias(name))
    one = ranked.agg(*aggs)
    return one.select(
        "entities",
        F.round("total_value", 2).alias("total_value"),
        *[F.round(F.when(F.col("total_value") > 0, F.col(c) / F.col("total_value") * 100.0), 2).alias(c) for c in cuts],
    )


def product_concentration(items: DataFrame) -> DataFrame:
    """Share of the top 1/5/10/20 % of products, k = max(1, ceil(N p))."""
    revenue = items.groupBy("product_id").agg(F.sum(money("price")).alias("revenue"))
    cuts = {
        f"top_{p}_percent_share": F.greatest(F.lit(1), F.ceil(F.col("total_n") * (p / 100.0))) for p in (1, 5, 10, 20)
    }
    return top_share(revenue, "revenue", cuts).withColumnsRenamed({"entities": "products", "total_value": "total_revenue"})


def sales_operational(orders: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.agg(F.countDistinct("customer_unique_id").alias("people"))
    one = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        total("order_items_qty").alias("items"),
        total(money("order_value")).alias("value"),
        total(money("total_freight_value")).alias("freight"),
    ).crossJoin(F.broadcast(people))  # one-row frames
    return one.select(
        F.round(ratio(F.col("items"), F.col("orders")), 2).alias("average_items_per_order"),
        pct(F.col("freight"), F.col("value")).alias("freight_percentage_of_total_revenue"),
        F.round(ratio(F.col("value"), F.col("orders")), 2).alias("revenue_per_order"),
        F.round(ratio(F.col("value"), F.col("people")), 2).alias("revenue_per_customer"),
        F.col("people").alias("total_unique_customers_count"),
    )
