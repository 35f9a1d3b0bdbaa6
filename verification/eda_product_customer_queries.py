from __future__ import annotations

from marketlens.operators import eda_customers as C
from marketlens.operators import eda_products as P
from verification.registry import register
from verification.roles_sql import count_if, mmean, msum, pct, quant, rnd, with_roles

TOTALS = {
    "totals": """
  SELECT customer_unique_id, count(DISTINCT order_id) AS orders, coalesce(sum(order_value), 0) AS spend
  FROM customers LEFT JOIN c_orders USING (customer_id) GROUP BY 1"""
}


def stats_sql(x: str, table: str, group: str = "", drop: tuple[str, ...] = (), exact: bool = True) -> str:
    """The describe() columns over one expression. ``exact``: decimal or integer input."""
    mean = mmean(x) if exact else f"avg({x})"
    cols = {
        "n": f"count({x})",
        "null_count": f"count(*) - count({x})",
        "mean": rnd(mean),
        "std": rnd(f"coalesce(stddev_samp(CAST({x} AS DOUBLE)), 0)"),
        "min": rnd(f"min({x})"),
        "q25": rnd(quant(x, 0.25)),
        "median": rnd(quant(x, 0.5)),
        "q75": rnd(quant(x, 0.75)),
        "max": rnd(f"max({x})"),
        "skewness": rnd(f"coalesce(skewness(CAST({x} AS DOUBLE)), 0)", 4),
    }
    body = ", ".join(f"{e} AS {c}" for c, e in cols.items() if c not in drop)
    lead, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"SELECT {lead}{body} FROM {table}{tail}"


def totals(m):
    return C.person_totals(m.customers, m.curated().orders)


register(
    "eda_customer_geo",
    lambda m: C.customer_geography(m.customers),
    with_roles(
        f"""SELECT 'state' AS section, customer_state AS key, count(*) AS n FROM customers GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_city', customer_city, count(*) AS n FROM customers GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20)
UNION ALL SELECT 'total', 'cities', count(DISTINCT customer_city) FROM customers"""
    ),
)
register(
    "eda_customer_growth",
    lambda m: C.customer_growth(m.customers, m.orders),
    with_roles(
        """SELECT 'year' AS section, strftime(first, '%Y') AS key, count(*) AS customers FROM f GROUP BY 2
UNION ALL SELECT 'month', strftime(first, '%Y-%m'), count(*) FROM f GROUP BY 2""",
        {
            "f": """
  SELECT customer_unique_id, min(order_purchase_timestamp) AS first FROM customers JOIN m_orders USING (customer_id)
  GROUP BY 1"""
        },
    ),
)
register(
    "eda_repeat_rate",
    lambda m: C.repeat_rate(totals(m)),
    with_roles(
        f"""SELECT count(*) AS total_unique_customers, {count_if("orders > 1")} AS repeat_customers,
  {pct(count_if("orders > 1"), "count(*)")} AS repeat_purchase_rate_percent FROM totals""",
        TOTALS,
    ),
)
register(
    "eda_order_frequency",
    lambda m: C.order_frequency_stats(totals(m)),
    with_roles(stats_sql("orders", "totals", drop=("null_count", "skewness")), TOTALS),
)
register(
    "eda_order_frequency_histogram",
    lambda m: C.order_frequency_histogram(totals(m)),
    with_roles("SELECT orders, count(*) AS customers FROM totals GROUP BY 1", TOTALS),
)
register(
    "eda_customer_spend",
    lambda m: C.spend_stats(totals(m)),
    with_roles(
        stats_sql("spend", "totals", drop=("null_count", "std", "skewness")).replace("SELECT ", f"SELECT {msum('spend')} AS total, ", 1),
        TOTALS,
    ),
)


def _tier_sql(labels: list[str]) -> str:
    values = ", ".join(f"('{x}')" for x in labels)
    return f"""SELECT tier, count(t.customer_unique_id) AS customer_count, {msum("t.spend")} AS revenue_contribution,
  {pct("count(t.customer_unique_id)", "(SELECT count(*) FROM totals)")} AS customer_percentage,
  {pct("coalesce(sum(t.spend), 0)", "(SELECT sum(spend) FROM totals)")} AS revenue_percentage
FROM (VALUES {values}) l(tier) LEFT JOIN tagged t USING (tier) GROUP BY 1"""


register(
    "eda_value_tiers",
    lambda m: C.value_tiers(totals(m)),
    with_roles(
        _tier_sql(C.VALUE_TIERS),
        {
            **TOTALS,
            "tagged": f"""
  SELECT *, CASE WHEN CAST(spend AS DOUBLE) <= a THEN '{C.VALUE_TIERS[0]}'
                 WHEN CAST(spend AS DOUBLE) <= b THEN '{C.VALUE_TIERS[1]}' ELSE '{C.VALUE_TIERS[2]}' END AS tier
  FROM totals CROSS JOIN (SELECT {quant("spend", 0.25)} AS a, {quant("spend", 0.75)} AS b FROM totals)""",
        },
    ),
)
register(
    "eda_frequency_tiers",
    lambda m: C.frequency_tiers(totals(m)),
    with_roles(
        _tier_sql(C.FREQUENCY_TIERS),
        {
            **TOTALS,
            "tagged": f"""
  SELECT *, CASE WHEN orders = 1 THEN '{C.FREQUENCY_TIERS[0]}' WHEN orders BETWEEN 2 AND 5 THEN '{C.FREQUENCY_TIERS[1]}'
                 WHEN orders > 5 THEN '{C.FREQUENCY_TIERS[2]}' END AS tier FROM totals""",
        },
    ),
)

# ---- products

DIMS = {
    "dims": "\n  UNION ALL ".join(f"SELECT '{n}' AS dimension, {c} AS value FROM c_products" for n, c in P.DIMENSIONS.items())
}
PERF = {
    "perf": """
  SELECT product_id, count(order_item_id) AS items_sold, sum(price) AS revenue, count(DISTINCT order_id) AS distinct_orders
  FROM order_items GROUP BY 1"""
}

register(
    "eda_effective_category",
    lambda m: P.effective_categories(m.curated().products),
    with_roles("SELECT product_id, effective_category FROM c_products"),
)
register(
    "eda_category_counts",
    lambda m: P.category_counts(m.curated().products),
    with_roles(
        """SELECT 'products' AS ranking, row_number() OVER (ORDER BY products DESC, effective_category) AS rank, effective_category, products
FROM (SELECT effective_category, count(*) AS products FROM c_products GROUP BY 1) ORDER BY 2 LIMIT 20"""
    ),
)
CAT_REV = {"cat_rev": f"SELECT effective_category, {msum('price')} AS revenue, count(order_id) AS order_item_count FROM item_cats GROUP BY 1"}
register(
    "eda_category_revenue",
    lambda m: P.category_revenue(m.order_items, m.curated().products),
    with_roles("SELECT * FROM cat_rev", CAT_REV),
)
register(
    "eda_category_rank",
    lambda m: P.category_rank(m.order_items, m.curated().products),
    with_roles(
        "SELECT effective_category, revenue, row_number() OVER (ORDER BY revenue DESC, effective_category) AS revenue_rank FROM cat_rev",
        CAT_REV,
    ),
)
register(
    "eda_dim_stats",
    lambda m: P.dimension_stats(m.curated().products),
    with_roles(stats_sql("value", "dims", "dimension"), DIMS),
)
register(
    "eda_iqr_outliers",
    lambda m: P.dimension_outliers(m.curated().products),
    with_roles(
        f"""SELECT dimension, {count_if("value < low OR value > high")} AS outlier_count,
  {pct(count_if("value < low OR value > high"), "count(value)")} AS outlier_percentage,
  {rnd("max(low)")} AS lower_bound, {rnd("max(high)")} AS upper_bound FROM dims JOIN fences USING (dimension) GROUP BY 1""",
        {
            **DIMS,
            "fences": f"""
  SELECT dimension, a - (b - a) * 1.5 AS low, b + (b - a) * 1.5 AS high
  FROM (SELECT dimension, {quant("value", 0.25)} AS a, {quant("value", 0.75)} AS b FROM dims GROUP BY 1)""",
        },
    ),
)


def _top(ranking: str, col: str) -> str:
    return f"""SELECT '{ranking}' AS ranking, row_number() OVER (ORDER BY {col} DESC, product_id) AS rank, * FROM perf"""


register(
    "eda_product_perf",
    lambda m: P.top_products(m.order_items, m.curated().products),
    with_roles(
        f"""SELECT ranking, rank, product_id, effective_category, items_sold, {rnd("revenue")} AS total_revenue, distinct_orders
FROM ({_top("revenue", "revenue")} UNION ALL {_top("units", "items_sold")}) LEFT JOIN c_products USING (product_id)
WHERE rank <= 20""",
        PERF,
    ),
)
register(
    "eda_unsold_products",
    lambda m: P.unsold_products(m.order_items, m.products),
    with_roles(
        f"""SELECT count(*) AS unsold_count, {pct("count(*)", "(SELECT count(*) FROM products)")} AS unsold_percentage,
  coalesce((SELECT string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) FROM (SELECT product_id FROM u ORDER BY 1 LIMIT 10)), '') AS sample_product_ids
FROM u""",
        {"u": "SELECT product_id FROM products EXCEPT SELECT product_id FROM order_items"},
    ),
)
register(
    "eda_revenue_per_product",
    lambda m: P.revenue_per_product(m.order_items),
    with_roles(stats_sql("revenue", "perf"), PERF),
)
register(
    "eda_freight_by_category",
    lambda m: P.freight_by_category(m.order_items, m.curated().products),
    with_roles(
        f"""SELECT effective_category, {rnd(mmean("freight_value"))} AS avg_freight, {rnd(quant("freight_value", 0.5))} AS median_freight,
  {msum("freight_value")} AS total_freight, count(freight_value) AS order_items_count FROM item_cats GROUP BY 1"""
    ),
)
register(
    "eda_freight_corr",
    lambda m: P.freight_correlation(m.order_items, m.curated().products),
    with_roles(
        f"""SELECT {rnd("corr(CAST(freight_value AS DOUBLE), product_weight_g)", 4)} AS freight_vs_weight,
  {rnd("corr(CAST(freight_value AS DOUBLE), product_volume_cm3)", 4)} AS freight_vs_volume FROM item_cats"""
    ),
)
register(
    "eda_translation_coverage",
    lambda m: P.translation_coverage(m.curated().products),
    with_roles(
        f"""SELECT count(DISTINCT product_category_name) AS total_categories,
  count(DISTINCT CASE WHEN category_name_english IS NOT NULL THEN product_category_name END) AS categories_with_translation,
  count(DISTINCT CASE WHEN category_name_english IS NULL THEN product_category_name END) AS missing_translations_count,
  {pct("count(DISTINCT CASE WHEN category_name_english IS NOT NULL THEN product_category_name END)", "count(DISTINCT product_category_name)")} AS category_coverage_percent,
  {pct("count(category_name_english)", "count(*)")} AS product_coverage_percent FROM c_products"""
    ),
)
register(
    "eda_missing_translations",
    lambda m: P.missing_translations(m.curated().products),
    with_roles(
        "SELECT product_category_name, count(*) AS products FROM c_products WHERE category_name_english IS NULL GROUP BY 1"
    ),
)
