"""Cleansing and derivation: raw marketplace tables to curated ones.

Order of the generic steps: missing markers, whitespace, dates, numerics, duplicates; then
the dataset's own rules. Everything stays one lazy plan; the step counts of a dataset come
from one aggregation over the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import (
    count_if,
    days_between,
    is_present,
    money,
    strip_ws,
    title_case,
    zero_pad,
)
from marketlens.functions.skew import crowded_buckets
from marketlens.model import MALFORMED, RULES, DatasetRules

# The literal markers that mean "missing".
MISSING_MARKERS = ["", "null", "NULL", "None", "NONE", "NaN", "nan", "N/A", "n/a"]

TRANSFORM_ORDER = ["translations", "customers", "products", "order_items", "orders", "payments", "reviews"]


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


# ---- generic steps -------------------------------------------------------------------------


def clean_missing(df: DataFrame) -> DataFrame:
    """Missing markers to null. Runs before trimming, so ``' null '`` stays text."""
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING_MARKERS), F.col(c)) for c in string_columns(df)})


def clean_trim(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip_ws(c) for c in string_columns(df)})


def clean_dates(df: DataFrame, rules: DatasetRules) -> DataFrame:
    """Parse the date fields; what does not parse becomes null."""
    todo = [c for c in rules.date_fields if c in df.columns and dict(df.dtypes)[c] == "string"]
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in todo}) if todo else df


def clean_numeric(df: DataFrame, rules: DatasetRules) -> DataFrame:
    todo = [c for c in rules.bounds if c in df.columns and dict(df.dtypes)[c] == "string"]
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in todo}) if todo else df


def dedup_keys(df: DataFrame, rules: DatasetRules) -> list[str]:
    keys = rules.key
    return list(keys) if keys and all(k in df.columns for k in keys) else df.columns


def clean_dedup(df: DataFrame, rules: DatasetRules) -> DataFrame:
    """One row per key (all columns if there is none): the smallest by all other columns.

    Such an aggregate sorts its rows. To combine on the map side as well would sort, and spill, all rows a
    second time, which pays only for keys of many rows. So the rows meet by one exchange and are sorted
    there; only a crowded share of the keys is combined first, so that a key repeated in a third of all
    rows never gathers in one task the way it would in a ``row_number`` window.
    """
    keys = dedup_keys(df, rules)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    # Nulls sort last within the struct: (is null, value) pairs.
    first = F.min(F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))]))
    kinds = dict(df.dtypes)
    exact = [k for k in keys if kinds[k] not in ("double", "float")]  # others are grouped by normalised values
    if not exact:
        kept = df.groupBy(*keys).agg(first.alias("_row"))
    else:
        bucket, crowded = crowded_buckets(df, exact)
        few = df.filter(~bucket.isin(crowded)) if crowded else df
        kept = few.repartition(*exact).groupBy(*keys).agg(first.alias("_row"))
        if crowded:
            kept = kept.unionByName(df.filter(bucket.isin(crowded)).groupBy(*keys).agg(first.alias("_row")))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


# ---- customers -----------------------------------------------------------------------------


def normalise_city(c: Column) -> Column:
    return title_case(strip_ws(F.coalesce(c, F.lit("unknown"))))


def normalise_state(c: Column) -> Column:
    return F.upper(strip_ws(F.coalesce(c, F.lit("XX"))))


def normalise_zip(c: Column) -> Column:
    whole = F.coalesce(c.try_cast("double"), F.lit(0.0)).cast("long").cast("string")
    return zero_pad(whole, 5)


def clean_customers(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "customer_city": normalise_city(F.col("customer_city")),
            "customer_state": normalise_state(F.col("customer_state")),
            "customer_zip_code_prefix": normalise_zip(F.col("customer_zip_code_prefix")),
        }
    )


# ---- orders --------------------------------------------------------------------------------


def delay_days() -> Column:
    return F.round(days_between("order_delivered_customer_date", "order_estimated_delivery_date"), 2)


def fulfillment_days() -> Column:
    return F.round(days_between("order_delivered_carrier_date", "order_purchase_timestamp"), 2)


def delivery_days() -> Column:
    return F.round(days_between("order_delivered_customer_date", "order_purchase_timestamp"), 2)


def order_durations(orders: DataFrame) -> DataFrame:
    """Durations in days (null until delivered) and the delivered / late flags."""
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return orders.withColumns(
        {
            "delivery_delay_days": delay_days(),
            "fulfillment_days": fulfillment_days(),
            "delivery_days": delivery_days(),
            "is_delivered": F.coalesce(F.lower("order_status") == "delivered", F.lit(False)),
            "is_late_delivery": F.coalesce(late, F.lit(False)),
        }
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("order_items_qty"),
        money(F.sum(money("price"))).alias("total_items_price"),
        money(F.sum(money("freight_value"))).alias("total_freight_value"),
    )


def item_rollup(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item count and value per order; orders without items get zeros."""
    zero = F.lit(0).cast("decimal(18,2)")
    out = orders.join(items_per_order(items), "order_id", "left").withColumns(
        {
            "order_items_qty": F.coalesce("order_items_qty", F.lit(0)).cast("long"),
            "total_items_price": F.coalesce("total_items_price", zero),
            "total_freight_value": F.coalesce("total_freight_value", zero),
        }
    )
    return out.withColumn("order_value", money(F.col("total_items_price") + F.col("total_freight_value")))


# ---- products ------------------------------------------------------------------------------


def translate_category(products: DataFrame, translations: DataFrame) -> DataFrame:
    """English category in Title Case, ``Uncategorized`` when there is no translation.

    A repeated source name takes its greatest translation, so the join never multiplies rows.
    """
    english = translations.groupBy("product_category_name").agg(
        F.max("product_category_name_english").alias("category_name_english")
    )
    return products.join(english, "product_category_name", "left").withColumn(
        "category_name_english",
        title_case(F.coalesce("category_name_english", F.lit("Uncategorized"))),
    )


def product_volume(products: DataFrame) -> DataFrame:
    length, height, width = (
        F.col(c).try_cast("double") for c in ("product_length_cm", "product_height_cm", "product_width_cm")
    )
    return products.withColumn("product_volume_cm3", F.round(length * height * width, 2)).withColumn(
        "volumetric_weight_g", F.round(F.col("product_volume_cm3") / 6.0, 2)
    )


# ---- payments, reviews ---------------------------------------------------------------------


def payment_flags(payments: DataFrame) -> DataFrame:
    installments = F.coalesce(F.col("payment_installments").try_cast("double"), F.lit(1.0))
    return payments.withColumns(
        {
            "is_installment_payment": installments > 1,
            "is_voucher_payment": F.coalesce(F.lower("payment_type") == "voucher", F.lit(False)),
        }
    )


def review_flags(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns(
        {
            "has_comment_title": is_present("review_comment_title"),
            "has_comment_message": is_present("review_comment_message"),
        }
    )


# ---- whole datasets ------------------------------------------------------------------------


def transform_dataset(name: str, df: DataFrame, context: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All generic steps, then the dataset's own, as one lazy plan."""
    rules, context = RULES[name], context or {}
    df = df.drop(MALFORMED)
    out = clean_dedup(clean_numeric(clean_dates(clean_trim(clean_missing(df)), rules), rules), rules)
    if name == "customers":
        out = clean_customers(out)
    elif name == "orders":
        out = order_durations(out)
        if "order_items" in context:
            out = item_rollup(out, context["order_items"])
    elif name == "products":
        if "translations" in context:
            out = translate_category(out, context["translations"])
        else:
            out = out.withColumn("category_name_english", F.lit("Uncategorized"))
        out = product_volume(out)
    elif name == "payments":
        out = payment_flags(out)
    elif name == "reviews":
        out = review_flags(out)
    return out


def transform_batch(
    tables: Mapping[str, DataFrame], keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Dependency order; later datasets see the transformed versions of earlier ones.

    ``keep`` may store the items, which feed both their own table and the orders.
    """
    done: dict[str, DataFrame] = {}
    for name in TRANSFORM_ORDER:
        if name in tables:
            out = transform_dataset(name, tables[name], {**tables, **done})
            done[name] = keep(out, name) if keep and name == "order_items" else out
    return done


def transform_report(name: str, raw: DataFrame, transformed: DataFrame) -> DataFrame:
    """One row per step with the number of affected cells or rows.

    Step counts need the raw cells, so they are one aggregate over the raw rows plus one
    over the transformed rows; nothing is run per step.
    """
    rules, texts = RULES[name], string_columns(raw)
    marked = [count_if(F.col(c).isin(MISSING_MARKERS)) for c in texts]
    kept = [F.when(~F.col(c).isin(MISSING_MARKERS), F.col(c)) for c in texts]
    trimmed = [count_if(k != strip_ws(k)) for k in kept]

    def add(cols: list[Column]) -> Column:
        out = F.lit(0).cast("long")
        for c in cols:
            out = out + c
        return out

    before = raw.agg(
        F.count(F.lit(1)).alias("rows_in"), add(marked).alias("marked"), add(trimmed).alias("trimmed")
    )
    derived = {
        "orders": ["delivery_delay_days", "fulfillment_days", "delivery_days"],
        "products": ["product_volume_cm3"],
    }.get(name, [])
    after = transformed.agg(
        F.count(F.lit(1)).alias("rows_out"), *[F.count(c).alias(f"set_{c}") for c in derived]
    )
    # The names of the steps.
    steps = [("missing_value_standardization", F.col("marked")), ("string_cleansing", F.col("trimmed"))]
    if rules.date_fields:
        steps.append(("date_conversions", F.col("rows_in")))
    if rules.bounds:
        steps.append(("numeric_conversions", F.col("rows_in")))
    steps.append(("deduplication", F.col("rows_in") - F.col("rows_out")))
    steps += [(f"calc_{c}", F.col(f"set_{c}")) for c in derived]
    own = {
        "customers": ["normalize_city", "normalize_state", "standardize_zip"],
        "orders": ["operational_flags"],
        "payments": ["operational_flags"],
        "reviews": ["operational_flags"],
    }.get(name, [])
    steps += [(s, F.col("rows_out")) for s in own]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(i + 1).alias("step_order"),
                F.lit(s).alias("step"),
                c.cast("long").alias("affected_rows"),
            )
            for i, (s, c) in enumerate(steps)
        ]
    )
    return before.crossJoin(F.broadcast(after)).select(F.inline(rows))  # two one-row frames
