from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from marketlens.operators import profile as P
from verification.registry import register
from verification.roles_sql import dbl, pct, quant, rnd, with_roles

ITEM_KEYS = ["order_id", "order_item_id"]
PRODUCT_NUM = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
ORDER_TYPES = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz",
    "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
}

register(
    "profile_overview",
    lambda m: P.overview(m.order_items),
    with_roles("SELECT count(*) AS total_rows, CAST(7 AS BIGINT) AS total_columns FROM order_items"),
)
register(
    "profile_missing",
    lambda m: P.missing_values(m.orders).drop("data_type"),
    with_roles(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, {pct(f'(count(*) - count({c}))', 'count(*)')} AS missing_percent FROM m_orders"
            for c in ORDER_TYPES
        )
    ),
)
register(
    "profile_dtypes",
    lambda m: P.data_types(m.orders).drop("data_type"),
    with_roles(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS non_null_count, count(*) - count({c}) AS null_count FROM m_orders" for c in ORDER_TYPES
        )
    ),
)
register(
    "profile_duplicates",
    lambda m: P.duplicates(m.order_items, ITEM_KEYS),
    with_roles(
        f"""SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM order_items)) AS exact_duplicate_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT order_id, order_item_id FROM order_items)) AS key_duplicate_rows,
  {pct("(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM order_items)))", "count(*)")} AS exact_duplicate_percent FROM order_items"""
    ),
)


def _numeric(c: str, table: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f"avg({x})", 6)} AS mean, {rnd(f"stddev_samp({x})", 6)} AS std,
  {x.replace(c, f"min({c})")} AS min, {quant(c, 0.25)} AS q25, {quant(c, 0.5)} AS median, {quant(c, 0.75)} AS q75,
  {x.replace(c, f"max({c})")} AS max, {rnd(f"skewness({x})", 4)} AS skewness, count(*) - count({c}) AS null_count FROM {table}"""


def _rounded(df):
    return df.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


register(
    "profile_numeric",
    lambda m: _rounded(P.numeric_statistics(m.products.drop("product_id"))),
    with_roles("\nUNION ALL ".join(_numeric(c, "products") for c in PRODUCT_NUM)),
)


def _categorical(c: str, table: str) -> str:
    return f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM {table}) AS unique_count, {c} AS top_value, count(*) AS top_frequency,
  {pct("count(*)", f"(SELECT count(*) FROM {table})")} AS top_percent, (SELECT count(*) - count({c}) FROM {table}) AS null_count
FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} QUALIFY row_number() OVER (ORDER BY count(*) DESC, {c}) = 1"""


register(
    "profile_categorical",
    lambda m: P.categorical_statistics(m.customers.select("customer_city", "customer_state")),
    with_roles("\nUNION ALL ".join(f"({_categorical(c, 'customers')})" for c in ("customer_city", "customer_state"))),
)
register("profile_full", lambda m: P.profile_report("payments", m.payments, ["order_id", "payment_sequential"]))
register("profile_report", lambda m: P.profile_report("reviews", m.reviews, ["review_id", "order_id"]))
register(
    "profile_batch",
    lambda m: P.profile_batch(
        m.as_dict(),
        {
            "customers": ["customer_id"],
            "orders": ["order_id"],
            "order_items": ["order_id", "order_item_id"],
            "payments": ["order_id", "payment_sequential"],
            "reviews": ["review_id", "order_id"],
            "products": ["product_id"],
            "translations": ["product_category_name"],
            "sellers": ["seller_id"],
        },
    ),
)
register(
    "hist_numeric",
    lambda m: P.histogram(m.payments, "payment_value").select("bin", F.round("low", 2).alias("low"), F.round("high", 2).alias("high"), "n"),
    with_roles(
        f"""SELECT b.i AS bin, {rnd("lo + b.i * w")} AS low, {rnd("lo + (b.i + 1) * w")} AS high, count(v) AS n
FROM range(30) b(i) CROSS JOIN span LEFT JOIN
  (SELECT {dbl("payment_value")} AS v, least(29, floor(({dbl("payment_value")} - lo) / w)) AS k FROM payments CROSS JOIN span) p ON p.k = b.i
GROUP BY b.i, lo, w""",
        {
            "span": f"SELECT {dbl('min(payment_value)')} AS lo, ({dbl('max(payment_value)')} - {dbl('min(payment_value)')}) / 30 AS w FROM payments"
        },
    ),
)
register(
    "topn_categories",
    lambda m: P.top_categories(m.customers, "customer_state"),
    with_roles(
        """SELECT 'customer_state' AS ranking, row_number() OVER (ORDER BY count(*) DESC, customer_state) AS rank,
  customer_state AS value, count(*) AS n FROM customers GROUP BY 3 ORDER BY 2 LIMIT 10"""
    ),
)
_pairs = list(combinations(PRODUCT_NUM, 2))
register(
    "corr_matrix",
    lambda m: P.correlation_matrix(m.products, PRODUCT_NUM),
    with_roles(
        "\nUNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, {rnd(f'corr({a}, {b})', 4)} AS r FROM products" for a, b in _pairs)
    ),
)
register(
    "resample_sum",
    lambda m: P.resample_sum(m.curated().orders, "order_purchase_timestamp", "order_value", "day"),
    with_roles(
        f"""SELECT strftime(d.day, '%Y-%m-%d') AS period, {dbl("coalesce(sum(order_value), 0)")} AS total
FROM (SELECT unnest(generate_series(min(order_purchase_timestamp), max(order_purchase_timestamp), INTERVAL 1 DAY)) AS day FROM c_orders) d
LEFT JOIN c_orders o ON date_trunc('day', o.order_purchase_timestamp) = d.day GROUP BY 1"""
    ),
)
