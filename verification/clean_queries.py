from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.model import RULES
from marketlens.operators import clean as C
from verification import dirty
from verification.dirty import DIRTY, sql_missing, sql_strip, sql_title
from verification.registry import ORACLES, QUERIES, register
from verification.roles_sql import big, count_if, dbl, rnd, with_roles

TEXTS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]


def on_dirty(name: str, source, fn, oracle: str) -> None:
    QUERIES[name] = lambda spark, base: fn(source(spark, base))
    ORACLES[name] = oracle


on_dirty(
    "clean_missing",
    dirty.customers,
    C.clean_missing,
    with_roles("SELECT " + ", ".join(f"{sql_missing(c)} AS {c}" for c in TEXTS) + " FROM dirty_customers", DIRTY),
)
on_dirty(
    "clean_trim",
    dirty.customers,
    C.clean_trim,
    with_roles("SELECT " + ", ".join(f"{sql_strip(c)} AS {c}" for c in TEXTS) + " FROM dirty_customers", DIRTY),
)


def _dates(df):
    out = C.clean_dates(df, RULES["orders"])
    return out.select("order_id", F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss").alias("purchased"))


on_dirty(
    "clean_dates",
    dirty.orders,
    _dates,
    with_roles(
        "SELECT order_id, strftime(TRY_CAST(order_purchase_timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS purchased FROM dirty_orders",
        DIRTY,
    ),
)
on_dirty(
    "clean_numeric",
    dirty.customers,
    lambda df: C.clean_numeric(df, RULES["customers"]).select("customer_id", "customer_zip_code_prefix"),
    with_roles(
        "SELECT customer_id, TRY_CAST(customer_zip_code_prefix AS DOUBLE) AS customer_zip_code_prefix FROM dirty_customers", DIRTY
    ),
)
on_dirty(
    "cust_city",
    dirty.customers,
    lambda df: df.select("customer_id", C.normalise_city(F.col("customer_city")).alias("customer_city")),
    with_roles(
        f"SELECT customer_id, {sql_title('s')} AS customer_city FROM (SELECT customer_id, {sql_strip('coalesce(customer_city, ' + chr(39) + 'unknown' + chr(39) + ')')} AS s FROM dirty_customers)",
        DIRTY,
    ),
)
on_dirty(
    "cust_state",
    dirty.customers,
    lambda df: df.select("customer_id", C.normalise_state(F.col("customer_state")).alias("customer_state")),
    with_roles(f"SELECT customer_id, upper(trim(coalesce(customer_state, 'XX'))) AS customer_state FROM dirty_customers", DIRTY),
)
on_dirty(
    "cust_zip",
    dirty.customers,
    lambda df: df.select("customer_id", C.normalise_zip(F.col("customer_zip_code_prefix")).alias("customer_zip_code_prefix")),
    with_roles(
        """SELECT customer_id, CASE WHEN length(z) < 5 THEN lpad(z, 5, '0') ELSE z END AS customer_zip_code_prefix
FROM (SELECT customer_id, CAST(CAST(trunc(coalesce(TRY_CAST(customer_zip_code_prefix AS DOUBLE), 0)) AS BIGINT) AS VARCHAR) AS z FROM dirty_customers)""",
        DIRTY,
    ),
)

DEDUP = {
    "u_items": """
  SELECT * FROM order_items QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
    ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value) = 1""",
    "u_sums": """
  SELECT order_id, count(order_item_id) AS q, sum(price) AS p, sum(freight_value) AS f FROM u_items GROUP BY 1""",
}
ITEM_COLS = "order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"


def plain_items(df):
    return df.select(
        "order_id",
        F.col("order_item_id").cast("long").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


register(
    "clean_dedup",
    lambda m: plain_items(C.clean_dedup(m.order_items, RULES["order_items"])),
    with_roles(f"SELECT {ITEM_COLS} FROM u_items", DEDUP),
)
for _id, _col in (
    ("ord_delay_days", "delivery_delay_days"),
    ("ord_fulfillment_days", "fulfillment_days"),
    ("ord_delivery_days", "delivery_days"),
):
    register(
        _id,
        lambda m, c=_col: C.order_durations(m.orders).select("order_id", c),
        with_roles(f"SELECT order_id, {_col} FROM c_orders"),
    )
register(
    "ord_flags",
    lambda m: C.order_durations(m.orders).select("order_id", "is_delivered", "is_late_delivery"),
    with_roles("SELECT order_id, is_delivered, is_late_delivery FROM c_orders"),
)


def plain_rollup(df):
    return df.select(
        "order_id",
        "order_items_qty",
        *[F.col(c).cast("double").alias(c) for c in ("total_items_price", "total_freight_value", "order_value")],
    )


register(
    "ord_item_rollup",
    lambda m: plain_rollup(C.item_rollup(m.orders, m.order_items)),
    with_roles(
        f"""SELECT order_id, order_items_qty, {dbl("total_items_price")} AS total_items_price,
  {dbl("total_freight_value")} AS total_freight_value, {dbl("order_value")} AS order_value FROM c_orders"""
    ),
)
register(
    "prod_translate",
    lambda m: C.translate_category(m.products, m.translations).select("product_id", "category_name_english"),
    with_roles(
        """SELECT product_id, upper(s[1]) || lower(s[2:]) AS category_name_english
FROM (SELECT product_id, coalesce(product_category_name_english, 'Uncategorized') AS s
      FROM products LEFT JOIN translations USING (product_category_name))"""
    ),
)
register(
    "prod_volume",
    lambda m: C.product_volume(m.products).select("product_id", "product_volume_cm3", "volumetric_weight_g"),
    with_roles(
        f"""SELECT product_id, {rnd("v")} AS product_volume_cm3, {rnd("v / 6.0")} AS volumetric_weight_g
FROM (SELECT product_id, product_length_cm * product_height_cm * product_width_cm AS v FROM products)"""
    ),
)
register(
    "pay_flags",
    lambda m: C.payment_flags(m.payments).groupBy("is_installment_payment", "is_voucher_payment").agg(F.count("*").alias("payments")),
    with_roles(
        """SELECT payment_installments > 1 AS is_installment_payment, payment_type = 'voucher' AS is_voucher_payment,
  count(*) AS payments FROM payments GROUP BY 1, 2"""
    ),
)
register(
    "rev_flags",
    lambda m: C.review_flags(m.reviews).select("review_id", "has_comment_title", "has_comment_message"),
    with_roles(
        """SELECT review_id, coalesce(regexp_matches(review_comment_title, '[^[:space:]]'), FALSE) AS has_comment_title,
  coalesce(regexp_matches(review_comment_message, '[^[:space:]]'), FALSE) AS has_comment_message FROM reviews"""
    ),
)


def raw(m):
    from verification.quality_queries import raw_tables

    return raw_tables(m)


register(
    "transform_batch_orders",
    lambda m: plain_rollup(C.transform_batch(raw(m))["orders"]),
    with_roles(
        f"""SELECT order_id, coalesce(q, 0) AS order_items_qty, {dbl("coalesce(p, 0)")} AS total_items_price,
  {dbl("coalesce(f, 0)")} AS total_freight_value, {dbl("coalesce(p, 0) + coalesce(f, 0)")} AS order_value
FROM m_orders LEFT JOIN u_sums USING (order_id)""",
        DEDUP,
    ),
)

#: Per dataset: metric, over the transformed rows, and in SQL over the given ones.
_TRANSFORMED = {
    "customers": [("zip_chars", lambda: F.sum(F.length("customer_zip_code_prefix")), "sum(5)"), ("states", lambda: F.count_distinct("customer_state"), "count(DISTINCT upper(customer_state))")],
    "orders": [
        ("order_value", lambda: F.sum("order_value"), "max((SELECT sum(p + f) FROM u_sums JOIN m_orders USING (order_id)))"),
        ("delivered", lambda: F.count_if("is_delivered"), "count(*) FILTER (order_status = 'delivered')"),
        ("purchases", lambda: F.count("order_purchase_timestamp"), "count(order_purchase_timestamp)"),
    ],
    "order_items": [("price", lambda: F.sum("price"), "sum(price)"), ("freight", lambda: F.sum("freight_value"), "sum(freight_value)"), ("sellers", lambda: F.count_distinct("seller_id"), "count(DISTINCT seller_id)")],
    "products": [
        ("volume", lambda: F.sum("product_volume_cm3"), "sum(product_length_cm * product_height_cm * product_width_cm)"),
        ("translated", lambda: F.count_if(F.col("category_name_english") != "Uncategorized"), "count(*) FILTER (product_category_name IN (SELECT product_category_name FROM translations))"),
    ],
    "payments": [
        ("instalments", lambda: F.count_if("is_installment_payment"), "count(*) FILTER (payment_installments > 1)"),
        ("vouchers", lambda: F.count_if("is_voucher_payment"), "count(*) FILTER (payment_type = 'voucher')"),
        ("paid", lambda: F.sum("payment_value"), "sum(payment_value)"),
    ],
    "reviews": [
        ("titled", lambda: F.count_if("has_comment_title"), "count(*) FILTER (coalesce(regexp_matches(review_comment_title, '[^[:space:]]'), FALSE))"),
        ("commented", lambda: F.count_if("has_comment_message"), "count(*) FILTER (coalesce(regexp_matches(review_comment_message, '[^[:space:]]'), FALSE))"),
        ("score", lambda: F.sum("review_score"), "sum(review_score)"),
    ],
    "translations": [("names", lambda: F.count_distinct("product_category_name_english"), "count(DISTINCT product_category_name_english)")],
}


def _all_transformed(m):
    """All seven datasets: rows and sums over what each transformation derives."""
    done, parts = C.transform_batch(raw(m)), []
    for name, metrics in _TRANSFORMED.items():
        pairs = [("rows", F.count(F.lit(1))), *[(k, c()) for k, c, _ in metrics]]
        one = done[name].agg(*[c.cast("double").alias(k) for k, c in pairs])  # one row
        rows = F.array(*[F.struct(F.lit(name).alias("dataset"), F.lit(k).alias("metric"), F.round(k, 2).alias("value")) for k, _ in pairs])
        parts.append(one.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def _transformed_sql() -> str:
    parts = []
    for name, metrics in _TRANSFORMED.items():
        keys = RULES[name].key
        rows = {"orders": "m_orders", "order_items": "u_items"}.get(name, name)
        unique = f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join([c for c in RULES[name].types if c not in keys] or keys)}) = 1)"
        source = rows if name in ("orders", "order_items") else unique
        for k, sql in [("rows", "count(*)"), *[(k, sql) for k, _, sql in metrics]]:
            parts.append(f"SELECT '{name}' AS dataset, '{k}' AS metric, {rnd(f'CAST({sql} AS DOUBLE)')} AS value FROM {source} t")
    return "\nUNION ALL ".join(parts)


register("transform_batch", _all_transformed, with_roles(_transformed_sql(), DEDUP))


def _transform_report(spark, base):
    df = dirty.customers(spark, base)
    return C.transform_report("customers", df, C.transform_dataset("customers", df)).withColumn(
        "step_order", F.col("step_order").cast("long")
    )


_any_missing = " + ".join(count_if(f"{c} IN ({', '.join(dirty._MARK)})") for c in TEXTS)
_any_trim = " + ".join(count_if(f"{sql_missing(c)} <> {sql_strip(c)}") for c in TEXTS)
QUERIES["transform_dataset"] = _transform_report
ORACLES["transform_dataset"] = with_roles(
    f"""SELECT 'customers' AS dataset, i AS step_order, s AS step, {big("n")} AS affected_rows FROM (
SELECT 1::BIGINT AS i, 'missing_value_standardization' AS s, {_any_missing} AS n FROM dirty_customers
UNION ALL SELECT 2, 'string_cleansing', {_any_trim} FROM dirty_customers
UNION ALL SELECT 3, 'numeric_conversions', count(*) FROM dirty_customers
UNION ALL SELECT 4, 'deduplication', count(*) - count(DISTINCT customer_id) FROM dirty_customers
UNION ALL SELECT 5, 'normalize_city', count(DISTINCT customer_id) FROM dirty_customers
UNION ALL SELECT 6, 'normalize_state', count(DISTINCT customer_id) FROM dirty_customers
UNION ALL SELECT 7, 'standardize_zip', count(DISTINCT customer_id) FROM dirty_customers)""",
    DIRTY,
)
