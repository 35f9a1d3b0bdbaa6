"""Customer feature tables: the 36-column feature store and the cutoff-dated temporal store.

Every fact table is reduced per order before it meets the orders, and per person after, so a
person or order holding a large share of the rows is combined on the map side. Feature groups
are joined on the person key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, days_between, dbl, money, money_mean, ratio, total
from marketlens.functions.ordering import distinct_values, ranked_quantiles, running_totals
from marketlens.functions.skew import join_by_frequency
from marketlens.operators.clean import items_per_order
from marketlens.operators.eda_products import items_with_category
from marketlens.sources.workspace import stored

PERSON = "customer_unique_id"
DAYS_PER_MONTH = 30.44
HORIZON_DAYS = 90

# Output columns and their order.
FEATURE_GROUPS: dict[str, list[str]] = {
    "customer_profile": [
        "customer_id",
        "customer_unique_id",
        "state",
        "city",
        "customer_age_days",
        "first_purchase_date",
        "last_purchase_date",
    ],
    "rfm_features": ["recency_days", "frequency_orders", "monetary_value", "avg_order_value"],
    "purchase_behaviour": [
        "total_items",
        "avg_items_per_order",
        "favorite_product_category",
        "unique_categories",
        "repeat_purchase_rate",
    ],
    "payment_features": [
        "preferred_payment_method",
        "avg_payment_value",
        "avg_installments",
        "installment_ratio",
        "voucher_usage_ratio",
    ],
    "delivery_features": ["avg_delivery_days", "avg_delivery_delay", "late_delivery_ratio", "avg_freight_value"],
    "review_features": ["avg_review_score", "positive_review_ratio", "negative_review_ratio", "review_count"],
    "revenue_features": ["total_revenue", "revenue_rank_percentile", "customer_value_tier"],
    "derived_features": [
        "days_between_orders_mean",
        "order_value_std",
        "spending_velocity",
        "order_frequency_per_month",
    ],
}
FEATURE_COLUMNS = [c for cols in FEATURE_GROUPS.values() for c in cols]


def share(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    num, den = (F.col(c) if isinstance(c, str) else c for c in (numerator, denominator))
    return F.round(ratio(num, den), digits)


def rounded(c: str, digits: int = 2, default: float = 0.0) -> Column:
    return F.round(F.coalesce(dbl(c), F.lit(default)), digits)


def person_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders with their person, state and city."""
    people = customers.select("customer_id", PERSON, "customer_state", "customer_city")
    return orders.join(people, "customer_id")


def most_frequent(n: str, value: str) -> Column:
    """Most frequent value, ties to the smallest: needs (value, n) rows per person."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(n)).alias("neg"), F.col(value).alias("value"))))
    return best["value"]


# ---- feature groups ------------------------------------------------------------------------


def order_profile(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per person, over its orders: profile, RFM, delivery and order-gap inputs.

    Orders are reduced per customer id first (combined on the map side, whatever its share),
    then joined to the persons and merged. What needs a distinct count or a struct, and so a sort of its
    rows, is reduced apart from the many sums, which are hashed.
    """
    ts = F.col("order_purchase_timestamp")
    taken = days_between("order_delivered_customer_date", "order_purchase_timestamp")
    delay = days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    value = dbl("order_value")
    per_customer = orders.groupBy("customer_id").agg(
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
        F.count(ts).alias("dated"),
        F.sum(money("order_value")).alias("money"),
        F.count(value).alias("value_n"),
        F.avg(value).alias("value_mean"),
        (F.var_pop(value) * F.count(value)).alias("value_m2"),
        F.sum("order_items_qty").alias("items"),
        F.sum(money("total_freight_value")).alias("freight"),
        F.count("total_freight_value").alias("freight_n"),
        F.sum(taken).alias("taken"),
        F.count(taken).alias("taken_n"),
        F.sum(delay).alias("delay"),
        F.count(delay).alias("delay_n"),
        count_if(delay > 0).alias("late"),
        F.count("order_delivered_customer_date").alias("delivered"),
    )
    per_order = orders.groupBy("customer_id", "order_id").agg(F.max(ts).alias("ts"))
    latest = per_order.groupBy("customer_id").agg(
        F.max(F.struct("ts", "order_id")).alias("latest"), F.count("order_id").alias("orders")
    )
    people = customers.select("customer_id", PERSON, "customer_state", "customer_city")
    joined = per_customer.join(latest, "customer_id").join(people, "customer_id")
    gaps = F.sum("dated") - 1  # the gaps between consecutive orders sum to last - first
    n, mean = F.col("value_n"), F.col("value_mean")
    # Merged sum of squares about the overall mean, from the parts' means and sums of squares.
    raw = F.sum(F.col("value_m2") + n * mean * mean)
    overall = F.sum(n * mean) / F.sum(n)
    spread = F.greatest(F.lit(0.0), raw - F.sum(n) * overall * overall)
    return joined.groupBy(PERSON).agg(
        F.max_by("customer_state", F.when(F.col("customer_state").isNotNull(), F.col("latest"))).alias("state"),
        F.max_by("customer_city", F.when(F.col("customer_city").isNotNull(), F.col("latest"))).alias("city"),
        F.min("first").alias("first_purchase"),
        F.max("last").alias("last_purchase"),
        F.sum("orders").alias("frequency_orders"),
        F.sum("money").alias("monetary"),
        F.sum("items").alias("total_items"),
        (dbl(F.sum("freight")) / F.sum("freight_n")).alias("avg_freight_value"),
        ratio(F.sum("taken"), F.sum("taken_n"), None).alias("avg_delivery_days"),
        ratio(F.sum("delay"), F.sum("delay_n"), None).alias("avg_delivery_delay"),
        F.sum("late").alias("late_orders"),
        F.sum("delivered").alias("delivered_orders"),
        F.when(gaps > 0, days_between(F.max("last"), F.min("first")) / gaps).alias("days_between_orders_mean"),
        F.when(F.sum(n) > 1, F.sqrt(spread / (F.sum(n) - 1))).alias("order_value_std"),
    )


def category_habits(joined: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Favourite category (count, then name) and number of categories per person."""
    # An order has few items of one product, but many of few categories.
    narrow = items.select("order_id", "product_id", "order_item_id")
    per_order = items_with_category(narrow, products).groupBy("order_id", "effective_category").agg(F.count("order_item_id").alias("n"))
    per_person = (
        per_order.join(joined.select("order_id", PERSON), "order_id")
        .groupBy(PERSON, "effective_category")
        .agg(F.sum("n").alias("n"))
    )
    return per_person.groupBy(PERSON).agg(
        most_frequent("n", "effective_category").alias("favorite_product_category"),
        F.count(F.lit(1)).alias("unique_categories"),
    )


def payment_habits(joined: DataFrame, payments: DataFrame) -> DataFrame:
    n = F.col("payment_installments")
    per_order = payments.groupBy("order_id", "payment_type").agg(
        F.count("payment_sequential").alias("n"),
        F.sum(money("payment_value")).alias("value"),
        F.count("payment_value").alias("value_n"),
        F.sum(n).alias("installments"),
        F.count(n).alias("installments_n"),
        count_if(n > 1).alias("split"),
    )
    sums = ("n", "value", "value_n", "installments", "installments_n", "split")
    per_type = (
        per_order.join(joined.select("order_id", PERSON), "order_id")
        .groupBy(PERSON, "payment_type")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    return per_type.groupBy(PERSON).agg(
        most_frequent("n", "payment_type").alias("preferred_payment_method"),
        (dbl(F.sum("value")) / F.sum("value_n")).alias("avg_payment_value"),
        (dbl(F.sum("installments")) / F.sum("installments_n")).alias("avg_installments"),
        share(F.sum("split"), F.sum("n"), 4).alias("installment_ratio"),
        share(total(F.when(F.col("payment_type") == "voucher", F.col("n"))), F.sum("n"), 4).alias("voucher_usage_ratio"),
    )


def review_habits(joined: DataFrame, reviews: DataFrame) -> DataFrame:
    s = F.col("review_score")
    per_order = reviews.groupBy("order_id").agg(
        F.count("review_id").alias("n"),
        F.sum(s).alias("score"),
        F.count(s).alias("scored"),
        count_if(s >= 4).alias("positive"),
        count_if(s <= 2).alias("negative"),
    )
    return (
        per_order.join(joined.select("order_id", PERSON), "order_id")
        .groupBy(PERSON)
        .agg(
            F.sum("n").alias("review_count"),
            (dbl(F.sum("score")) / F.sum("scored")).alias("avg_review_score"),
            share(F.sum("positive"), F.sum("n"), 4).alias("positive_review_ratio"),
            share(F.sum("negative"), F.sum("n"), 4).alias("negative_review_ratio"),
        )
    )


def revenue_position(people: DataFrame, value: str) -> DataFrame:
    """Average-rank percentile and value tier per person, from ranks over distinct revenues."""
    ranked = stored(running_totals(distinct_values(people, value), [F.col(value)], ["n"]), "revenue-ranks")
    q = ranked_quantiles(ranked, value, {"q25": 0.25, "q75": 0.75})
    v = dbl(value)
    tier = F.when(v > F.col("q75"), "High Value").when(v > F.col("q25"), "Medium Value").otherwise("Low Value")
    per_value = ranked.crossJoin(F.broadcast(q)).select(  # one row of quartiles
        value,
        F.round((dbl("before_n") + (F.col("n") + 1) / 2.0) / F.col("total_n") * 100.0, 2).alias("revenue_rank_percentile"),
        tier.alias("customer_value_tier"),
    )
    # One row per distinct revenue; all persons without an order share the revenue 0.
    return join_by_frequency(people, per_value, value)


# ---- the feature store ---------------------------------------------------------------------


def feature_store(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """One row per person with the 36 features. ``orders`` carry their item totals."""
    joined = person_orders(customers, orders)
    home = customers.groupBy(PERSON).agg(
        F.min(F.struct("customer_id", "customer_state", "customer_city")).alias("home")
    ).select(PERSON, F.col("home.customer_state").alias("home_state"), F.col("home.customer_city").alias("home_city"))
    reference = orders.agg(F.max("order_purchase_timestamp").alias("reference"))  # one row

    wide = (
        home.join(order_profile(customers, orders), PERSON, "left")
        .join(category_habits(joined, items, products), PERSON, "left")
        .join(payment_habits(joined, payments), PERSON, "left")
        .join(review_habits(joined, reviews), PERSON, "left")
        .crossJoin(F.broadcast(reference))
        .withColumn("monetary", money(F.coalesce("monetary", F.lit(0))))
    )
    # The ranks need the revenues of all persons, so the joined groups are written once.
    wide = revenue_position(stored(wide, "feature-groups"), "monetary")

    frequency = F.coalesce("frequency_orders", F.lit(0))
    quantity = F.coalesce("total_items", F.lit(0))
    age = F.round(F.coalesce(days_between("reference", "first_purchase"), F.lit(0.0)), 2)
    months = F.greatest(F.lit(1.0), age / DAYS_PER_MONTH)
    revenue = F.round(dbl("monetary"), 2)
    features = {
        "customer_id": F.col(PERSON),
        PERSON: F.col(PERSON),
        "state": F.coalesce("state", "home_state", F.lit("Unknown")),
        "city": F.coalesce("city", "home_city", F.lit("Unknown")),
        "customer_age_days": age,
        "first_purchase_date": F.coalesce(F.date_format("first_purchase", "yyyy-MM-dd"), F.lit("Unknown")),
        "last_purchase_date": F.coalesce(F.date_format("last_purchase", "yyyy-MM-dd"), F.lit("Unknown")),
        "recency_days": F.round(F.coalesce(days_between("reference", "last_purchase"), F.lit(999.0)), 2),
        "frequency_orders": frequency,
        "monetary_value": revenue,
        "avg_order_value": share(revenue, frequency, 2),
        "total_items": quantity,
        "avg_items_per_order": share(quantity, frequency, 2),
        "favorite_product_category": F.coalesce("favorite_product_category", F.lit("Uncategorized")),
        "unique_categories": F.coalesce("unique_categories", F.lit(0)),
        "repeat_purchase_rate": F.when(frequency > 1, F.round((frequency - 1) / frequency, 4)).otherwise(0.0),
        "preferred_payment_method": F.coalesce("preferred_payment_method", F.lit("Uncategorized")),
        "avg_payment_value": rounded("avg_payment_value"),
        "avg_installments": rounded("avg_installments"),
        "installment_ratio": F.coalesce("installment_ratio", F.lit(0.0)),
        "voucher_usage_ratio": F.coalesce("voucher_usage_ratio", F.lit(0.0)),
        "avg_delivery_days": rounded("avg_delivery_days"),
        "avg_delivery_delay": rounded("avg_delivery_delay"),
        "late_delivery_ratio": share("late_orders", "delivered_orders", 4),
        "avg_freight_value": rounded("avg_freight_value"),
        "avg_review_score": rounded("avg_review_score"),
        "positive_review_ratio": F.coalesce("positive_review_ratio", F.lit(0.0)),
        "negative_review_ratio": F.coalesce("negative_review_ratio", F.lit(0.0)),
        "review_count": F.coalesce("review_count", F.lit(0)),
        "total_revenue": revenue,
        "revenue_rank_percentile": F.col("revenue_rank_percentile"),
        "customer_value_tier": F.col("customer_value_tier"),
        "days_between_orders_mean": rounded("days_between_orders_mean"),
        "order_value_std": rounded("order_value_std"),
        "spending_velocity": F.round(revenue / months, 2),
        "order_frequency_per_month": F.round(frequency / months, 4),
    }
    return wide.select(*[features[c].alias(c) for c in FEATURE_COLUMNS])


def feature_metadata(features: DataFrame) -> DataFrame:
    """Group and type of each feature, with the number of customers."""
    group = {c: g for g, cols in FEATURE_GROUPS.items() for c in cols}
    kinds = dict(features.dtypes)
    rows = F.array(
        *[
            F.struct(F.lit(group[c]).alias("feature_group"), F.lit(c).alias("feature"), F.lit(kinds[c]).alias("data_type"), F.col("n").alias("total_customers"))
            for c in FEATURE_COLUMNS
        ]
    )
    return features.agg(F.count(F.lit(1)).alias("n")).select(F.inline(rows))


# ---- the temporal store --------------------------------------------------------------------


def temporal_targets(joined: DataFrame, cutoff: str, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Item revenue per person in [cutoff, cutoff + horizon). ``joined`` carries order_price."""
    ts, start = F.col("order_purchase_timestamp"), F.lit(cutoff).cast("timestamp_ntz")
    future = joined.filter((ts >= start) & (ts < F.timestamp_add("DAY", F.lit(horizon_days), start)))
    return future.groupBy(PERSON).agg(money(total("order_price")).alias("target_future_clv"))


def with_item_sums(orders: DataFrame, items: DataFrame) -> DataFrame:
    sums = items_per_order(items).select(
        "order_id",
        F.col("total_items_price").alias("order_price"),
        F.col("total_freight_value").alias("order_freight"),
        F.col("order_items_qty").alias("items_qty"),
    )
    keep = [c for c in orders.columns if c not in ("order_price", "order_freight", "items_qty")]
    return orders.select(*keep).join(sums, "order_id", "left").fillna(0, ["items_qty"]).withColumns(
        {c: money(F.coalesce(c, F.lit(0))) for c in ("order_price", "order_freight")}
    )


def temporal_features(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    cutoff: str,
    horizon_days: int = HORIZON_DAYS,
) -> DataFrame:
    """Predictors from orders strictly before the cutoff, targets from the horizon after it.

    The cutoff filter comes first, so no later order can reach a predictor.
    """
    start = F.lit(cutoff).cast("timestamp_ntz")
    ts = F.col("order_purchase_timestamp")
    end = F.timestamp_add("DAY", F.lit(horizon_days), start)
    needed = orders.filter(ts < end).select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    joined = stored(person_orders(customers, with_item_sums(needed, items)), "dated-orders")
    observed = joined.filter(ts < start)
    taken = days_between("order_delivered_customer_date", "order_purchase_timestamp")
    delay = days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    # As in ``order_profile``, what needs a sort is reduced apart from the sums.
    first = observed.groupBy(F.col(PERSON).alias("_person")).agg(
        F.min(F.struct(ts, "order_id", "customer_state", "customer_city")).alias("_first")
    )
    distinct = observed.select(F.col(PERSON).alias("_buyer"), "order_id").distinct()
    counted = distinct.groupBy("_buyer").agg(F.count("order_id").alias("obs_frequency_orders"))
    profile = observed.groupBy(PERSON).agg(
        F.min(ts).alias("first_purchase"),
        F.max(ts).alias("last_purchase"),
        F.sum("order_price").alias("price"),
        F.sum("items_qty").alias("obs_total_items"),
        money_mean("order_freight").alias("obs_avg_freight"),
        F.avg(taken).alias("obs_avg_delivery_days"),
        F.avg(delay).alias("obs_avg_delivery_delay"),
        count_if(delay > 0).alias("late_orders"),
        F.count("order_delivered_customer_date").alias("delivered_orders"),
    )
    # Orders without a person are one group, like those of a person.
    profile = (
        profile.join(first, F.col(PERSON).eqNullSafe(F.col("_person")))
        .join(counted, F.col(PERSON).eqNullSafe(F.col("_buyer")))
        .withColumns({c: F.col(f"_first.{c}") for c in ("customer_state", "customer_city")})
    )
    pay = payment_habits(observed, payments).select(
        PERSON, F.col("avg_installments").alias("obs_avg_installments"), F.col("preferred_payment_method").alias("obs_preferred_payment")
    )
    rev = review_habits(observed, reviews).select(
        PERSON, F.col("avg_review_score").alias("obs_avg_review_score"), F.col("review_count").alias("obs_review_count")
    )
    wide = (
        profile.join(pay, PERSON, "left")
        .join(rev, PERSON, "left")
        .join(temporal_targets(joined, cutoff, horizon_days), PERSON, "left")
    )
    spent = dbl("price")
    target = F.round(F.coalesce(dbl("target_future_clv"), F.lit(0.0)), 2)
    return wide.select(
        F.col(PERSON).alias("customer_id"),
        PERSON,
        "customer_state",
        "customer_city",
        F.date_format("first_purchase", "yyyy-MM-dd").alias("first_purchase_date"),
        F.date_format("last_purchase", "yyyy-MM-dd").alias("last_purchase_date"),
        F.round(days_between(start, "last_purchase"), 2).alias("obs_recency_days"),
        "obs_frequency_orders",
        spent.alias("obs_monetary_value"),
        share(spent, "obs_frequency_orders", 2).alias("obs_avg_order_value"),
        F.round(days_between(start, "first_purchase"), 2).alias("obs_customer_age_days"),
        "obs_total_items",
        share("obs_total_items", "obs_frequency_orders", 2).alias("obs_avg_items_per_order"),
        "obs_avg_freight",
        "obs_avg_delivery_days",
        "obs_avg_delivery_delay",
        share("late_orders", "delivered_orders", 4).alias("obs_late_delivery_ratio"),
        rounded("obs_avg_installments", 2, 1.0).alias("obs_avg_installments"),
        F.coalesce("obs_preferred_payment", F.lit("credit_card")).alias("obs_preferred_payment"),
        rounded("obs_avg_review_score", 2, 4.0).alias("obs_avg_review_score"),
        F.coalesce("obs_review_count", F.lit(0)).alias("obs_review_count"),
        target.alias("target_future_clv"),
        (target > 0).cast("int").alias("target_repeat_buyer"),
    )
