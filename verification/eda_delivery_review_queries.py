from __future__ import annotations

from marketlens.operators import eda_delivery as D
from marketlens.operators import eda_reviews as R
from verification.eda_product_customer_queries import stats_sql
from verification.registry import register
from verification.roles_sql import big, count_if, days, dbl, mmean, pct, quant, rnd, with_roles

P, A, C, V, E = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ARRIVED = {
    "arr": f"""
  SELECT *, CAST(delivery_days AS DECIMAL(18,2)) AS dd, CAST(delivery_delay_days AS DECIMAL(18,2)) AS dl
  FROM cust_orders WHERE {V} IS NOT NULL"""
}


def orders_of(m):
    return m.curated().orders


register(
    "eda_stage_durations",
    lambda m: D.stage_durations(m.orders),
    with_roles(
        f"""SELECT order_id, {days(A, P)} AS approval_days, {days(C, A)} AS dispatch_days, {days(V, C)} AS transit_days,
  {days(V, P)} AS delivery_days, {days(V, E)} AS delay_days FROM m_orders"""
    ),
)
register(
    "eda_delivery_stats",
    lambda m: D.delivery_stats(orders_of(m)),
    with_roles(stats_sql("dd", "arr", drop=("std", "skewness", "null_count")), ARRIVED),
)
register(
    "eda_delay_stats", lambda m: D.delay_stats(orders_of(m)), with_roles(stats_sql("dl", "arr", drop=("null_count",)), ARRIVED)
)


def case_bucket(x: str, edges, last: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {e} THEN '{t}'" for e, t in edges) + f" WHEN {x} IS NOT NULL THEN '{last}' END"


def _buckets(x: str, edges, last: str) -> str:
    values = ", ".join(f"('{t}')" for t in D.labels(edges, last))
    return f"""SELECT bucket, count(b.order_id) AS count, {pct("count(b.order_id)", "(SELECT count(*) FROM arr)")} AS percentage
FROM (VALUES {values}) l(bucket) LEFT JOIN (SELECT order_id, {case_bucket(x, edges, last)} AS bucket FROM arr) b USING (bucket)
GROUP BY 1"""


register(
    "eda_delivery_buckets",
    lambda m: D.delivery_buckets(orders_of(m)),
    with_roles(_buckets("dd", D.DELIVERY_EDGES, D.DELIVERY_LAST), ARRIVED),
)
register(
    "eda_delay_buckets",
    lambda m: D.delay_buckets(orders_of(m)),
    with_roles(_buckets("dl", D.DELAY_EDGES, D.DELAY_LAST), ARRIVED),
)


def _mean_if(cond: str) -> str:
    x = f"CASE WHEN {cond} THEN dl END"
    return rnd(f"abs(CAST(sum({x}) AS DOUBLE) / count({x}))")


register(
    "eda_delay_summary",
    lambda m: D.delay_summary(orders_of(m)),
    with_roles(
        f"""SELECT count(*) AS delivered, {count_if("dl > 0")} AS late_count, {pct(count_if("dl > 0"), "count(*)")} AS late_percentage,
  {_mean_if("dl > 0")} AS average_days_late, {count_if("dl < 0")} AS early_count,
  {pct(count_if("dl < 0"), "count(*)")} AS early_percentage, {_mean_if("dl < 0")} AS average_days_early,
  {count_if("dl <= 0")} AS on_time_count, {pct(count_if("dl <= 0"), "count(*)")} AS on_time_percentage FROM arr""",
        ARRIVED,
    ),
)
STATES = {
    **ARRIVED,
    "states": f"""
  SELECT customer_state, {rnd(mmean("dd"))} AS average_delivery_days, {rnd(mmean("dl"))} AS average_delay_days,
         {pct(count_if("is_late_delivery"), "count(*)")} AS late_delivery_rate, count(order_id) AS order_count
  FROM arr GROUP BY 1""",
}
register(
    "eda_state_delivery",
    lambda m: D.state_ranking(orders_of(m), m.customers),
    with_roles(
        """SELECT * FROM (
SELECT 'fastest' AS ranking, row_number() OVER (ORDER BY average_delivery_days, customer_state) AS rank, * FROM states
UNION ALL SELECT 'slowest', row_number() OVER (ORDER BY average_delivery_days DESC, customer_state), * FROM states) WHERE rank <= 20""",
        STATES,
    ),
)
register(
    "eda_freight_delivery",
    lambda m: D.freight_by_state(orders_of(m), m.customers),
    with_roles(
        f"""SELECT customer_state, {rnd(mmean("total_freight_value"))} AS average_freight,
  {rnd(f"avg(CASE WHEN order_value <> 0 THEN {dbl('total_freight_value')} / {dbl('order_value')} * 100.0 END)")} AS freight_percentage
FROM arr GROUP BY 1""",
        ARRIVED,
    ),
)
register(
    "eda_freight_delivery_corr",
    lambda m: D.freight_delivery_correlation(orders_of(m)),
    with_roles(f"SELECT {rnd('corr(CAST(total_freight_value AS DOUBLE), delivery_days)', 4)} AS freight_vs_delivery_days FROM arr", ARRIVED),
)
register(
    "eda_freight_distribution",
    lambda m: D.freight_distribution(orders_of(m)),
    with_roles(stats_sql("total_freight_value", "c_orders")),
)


def _avg_pos(x: str) -> str:
    return rnd(f"avg(CASE WHEN {x} >= 0 THEN {x} END)")


register(
    "eda_delivery_operational",
    lambda m: D.delivery_operational(orders_of(m)),
    with_roles(
        f"""SELECT {_avg_pos(days(A, P))} AS average_order_processing_time_days, {_avg_pos(days(C, A))} AS average_carrier_time_days,
  {_avg_pos(days(V, C))} AS average_shipping_time_days,
  {pct(count_if("delivery_delay_days <= 0"), f"count({V})")} AS delivery_sla_achievement_rate_percent FROM c_orders"""
    ),
)

# ---- reviews

register(
    "eda_review_scores",
    lambda m: R.score_distribution(m.reviews),
    with_roles(
        f"""SELECT {big("review_score")} AS review_score, count(*) AS reviews, {pct("count(*)", "max(n)")} AS percentage,
  max(mean) AS average_review_score, max(med) AS median_review_score
FROM reviews CROSS JOIN (SELECT count(*) AS n, {rnd(dbl("sum(review_score)") + " / count(*)")} AS mean,
  {rnd(quant("review_score", 0.5))} AS med FROM reviews) GROUP BY 1"""
    ),
)
register(
    "eda_review_trend",
    lambda m: R.score_trend(m.reviews),
    with_roles(
        f"""SELECT strftime(review_creation_date, '%Y-%m') AS year_month,
  {rnd(dbl("sum(review_score)") + " / count(*)")} AS average_score, count(*) AS review_count FROM reviews GROUP BY 1"""
    ),
)
register(
    "eda_review_text",
    lambda m: R.text_presence(m.reviews),
    with_roles(
        f"""SELECT {pct(count_if("trim(review_comment_title) <> ''"), "count(*)")} AS percentage_with_title,
  {pct(count_if("regexp_matches(review_comment_message, '[^[:space:]]')"), "count(*)")} AS percentage_with_message,
  {rnd(dbl("sum(length(review_comment_message))") + " / count(review_comment_message)")} AS average_message_length FROM reviews"""
    ),
)
register(
    "eda_review_text_lengths",
    lambda m: R.text_lengths(m.reviews),
    with_roles(
        stats_sql("length", "lens", "field", drop=("null_count", "skewness")),
        {
            "lens": """
  SELECT 'title' AS field, length(review_comment_title) AS length FROM reviews WHERE review_comment_title IS NOT NULL
  UNION ALL SELECT 'message', length(review_comment_message) FROM reviews WHERE review_comment_message IS NOT NULL"""
        },
    ),
)
BASE = {
    "base": f"""
  SELECT r.review_id, r.order_id, r.review_score, o.customer_id, o.order_value, o.delivery_days, o.delivery_delay_days,
         {case_bucket("o.delivery_days", D.DELIVERY_EDGES, D.DELIVERY_LAST)} AS delivery_time_bucket,
         {case_bucket("o.delivery_delay_days", D.DELAY_EDGES, D.DELAY_LAST)} AS delivery_delay_bucket,
         coalesce(fc.effective_category, 'Uncategorized') AS effective_category,
         coalesce(fp.payment_type, 'Uncategorized') AS payment_type, c.customer_state
  FROM reviews r LEFT JOIN c_orders o USING (order_id) LEFT JOIN customers c USING (customer_id)
  LEFT JOIN (SELECT order_id, effective_category FROM item_cats
             QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id) = 1) fc USING (order_id)
  LEFT JOIN (SELECT order_id, payment_type FROM payments
             QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential, payment_type) = 1) fp USING (order_id)"""
}


def base_of(m):
    c = m.curated()
    return R.review_base(c.reviews, c.orders, c.customers, c.order_items, c.products, c.payments)


register(
    "eda_review_base",
    lambda m: base_of(m).drop("order_value"),
    with_roles("SELECT * EXCLUDE (order_value) FROM base", BASE),
)
register(
    "eda_satisfaction",
    lambda m: R.satisfaction(base_of(m)),
    with_roles(
        "\nUNION ALL ".join(
            f"""SELECT '{d}' AS dimension, {d} AS key, {rnd(dbl("sum(review_score)") + " / count(review_score)")} AS average_score,
  count(review_score) AS review_count FROM base WHERE {d} IS NOT NULL GROUP BY 2"""
            for d in R.DIMENSIONS
        ),
        BASE,
    ),
)
register(
    "eda_review_corr",
    lambda m: R.score_correlations(base_of(m)),
    with_roles(
        f"""SELECT {rnd("corr(CAST(review_score AS DOUBLE), delivery_delay_days)", 4)} AS score_vs_delay,
  {rnd("corr(CAST(review_score AS DOUBLE), delivery_days)", 4)} AS score_vs_delivery_time,
  {rnd("corr(CAST(review_score AS DOUBLE), CAST(order_value AS DOUBLE))", 4)} AS score_vs_order_value FROM base""",
        BASE,
    ),
)
register(
    "eda_category_ratings",
    lambda m: R.category_ratings(base_of(m)),
    with_roles(
        """SELECT * FROM (
SELECT 'highest' AS ranking, row_number() OVER (ORDER BY average_score DESC, effective_category) AS rank, * FROM cats
UNION ALL SELECT 'lowest', row_number() OVER (ORDER BY average_score, effective_category), * FROM cats) WHERE rank <= 10""",
        {
            **BASE,
            "cats": f"""
  SELECT effective_category, {rnd(dbl("sum(review_score)") + " / count(review_score)")} AS average_score,
         count(review_score) AS review_count FROM base GROUP BY 1 HAVING count(review_score) >= 10""",
        },
    ),
)
register(
    "eda_review_operational",
    lambda m: R.review_operational(m.reviews, m.orders),
    with_roles(
        f"""SELECT {count_if("review_score >= 4")} AS positive_reviews_count, {count_if("review_score = 3")} AS neutral_reviews_count,
  {count_if("review_score <= 2")} AS negative_reviews_count, {pct(count_if("review_score >= 4"), "count(*)")} AS positive_review_percentage,
  max(d) AS total_delivered_orders_count, count(DISTINCT order_id) AS reviewed_orders_count,
  {pct("count(DISTINCT order_id)", "max(d)")} AS review_coverage_percentage
FROM reviews CROSS JOIN (SELECT count({V}) AS d FROM m_orders)"""
    ),
)
