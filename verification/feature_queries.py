from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import features as X
from verification.registry import register
from verification.roles_sql import big, count_if, days, dbl, mmean, quant, rnd, with_roles

CUTOFF = "2000-01-01"
TS, DEL, EST = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"


def habits(where: str = "") -> dict[str, str]:
    """Per-person payment and review habits, optionally over some orders only."""
    on = f"cust_orders o {where}" if where else "cust_orders o"
    sel = f"(SELECT order_id, customer_unique_id FROM {on})"
    return {
        "pay": f"""
  SELECT customer_unique_id, {mmean("payment_value")} AS avg_payment_value,
    CAST(sum(payment_installments) AS DOUBLE) / count(payment_installments) AS avg_installments,
    {rnd(f"CAST({count_if('payment_installments > 1')} AS DOUBLE) / count(*)", 4)} AS installment_ratio,
    {rnd(f"CAST({count_if(chr(112) + 'ayment_type = ' + chr(39) + 'voucher' + chr(39))} AS DOUBLE) / count(*)", 4)} AS voucher_usage_ratio
  FROM payments JOIN {sel} s USING (order_id) GROUP BY 1""",
        "pref": f"""
  SELECT customer_unique_id, payment_type AS preferred FROM payments JOIN {sel} s USING (order_id) GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY count(*) DESC, payment_type) = 1""",
        "rev": f"""
  SELECT customer_unique_id, count(review_id) AS review_count, CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_review_score,
    {rnd(f"CAST({count_if('review_score >= 4')} AS DOUBLE) / count(*)", 4)} AS positive_review_ratio,
    {rnd(f"CAST({count_if('review_score <= 2')} AS DOUBLE) / count(*)", 4)} AS negative_review_ratio
  FROM reviews JOIN {sel} s USING (order_id) GROUP BY 1""",
    }


STORE = {
    "gaps": f"""
  SELECT customer_unique_id, avg(gap) AS gap FROM (
    SELECT customer_unique_id, {days(TS, "prev")} AS gap FROM (
      SELECT customer_unique_id, {TS}, lag({TS}) OVER (PARTITION BY customer_unique_id ORDER BY {TS}, order_id) AS prev FROM cust_orders))
  GROUP BY 1""",
    "prof": f"""
  SELECT customer_unique_id, min({TS}) AS first_ts, max({TS}) AS last_ts, count(DISTINCT order_id) AS freq, sum(order_value) AS money,
    sum(order_items_qty) AS items, {mmean("total_freight_value")} AS freight, avg({days(DEL, TS)}) AS dd, avg({days(DEL, EST)}) AS dl,
    {count_if(days(DEL, EST) + " > 0")} AS late, count({DEL}) AS delivered, stddev_samp(CAST(order_value AS DOUBLE)) AS sd
  FROM cust_orders GROUP BY 1""",
    "cats": """
  SELECT customer_unique_id, effective_category, count(*) AS n FROM item_cats JOIN cust_orders USING (order_id) GROUP BY 1, 2""",
    "fav": """
  SELECT customer_unique_id, effective_category AS fav, count(*) OVER (PARTITION BY customer_unique_id) AS uniq FROM cats
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, effective_category) = 1""",
    **habits(),
    "base": f"""
  SELECT c.customer_unique_id, c.customer_state, c.customer_city, p.*  EXCLUDE (customer_unique_id), coalesce(p.freq, 0) AS f, coalesce(p.items, 0) AS q,
    CAST(coalesce(p.money, 0) AS DOUBLE) AS rev, d.ref, fav, uniq, gap, preferred, avg_payment_value, avg_installments, installment_ratio,
    voucher_usage_ratio, review_count, avg_review_score, positive_review_ratio, negative_review_ratio,
    {rnd(f"coalesce({days('d.ref', 'p.first_ts')}, 0)")} AS age
  FROM customers c LEFT JOIN prof p USING (customer_unique_id) LEFT JOIN fav USING (customer_unique_id) LEFT JOIN gaps USING (customer_unique_id)
  LEFT JOIN pay USING (customer_unique_id) LEFT JOIN pref USING (customer_unique_id) LEFT JOIN rev USING (customer_unique_id)
  CROSS JOIN (SELECT max({TS}) AS ref FROM m_orders) d""",
}
_ratio = lambda a, b, n: rnd(f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0.0 END", n)
_zero = lambda c, n=2: rnd(f"coalesce({c}, 0)", n)
_str = lambda c: f"strftime({c}, '%Y-%m-%d')"

FEATURES_SQL = with_roles(
    f"""SELECT customer_unique_id AS customer_id, customer_unique_id, customer_state AS state, customer_city AS city, age AS customer_age_days,
  coalesce({_str("first_ts")}, 'Unknown') AS first_purchase_date, coalesce({_str("last_ts")}, 'Unknown') AS last_purchase_date,
  {rnd(f"coalesce({days('ref', 'last_ts')}, 999)")} AS recency_days, f AS frequency_orders, rev AS monetary_value,
  {_ratio("rev", "f", 2)} AS avg_order_value, {big("q")} AS total_items, {_ratio("q", "f", 2)} AS avg_items_per_order,
  coalesce(fav, 'Uncategorized') AS favorite_product_category, coalesce(uniq, 0) AS unique_categories,
  {rnd("CASE WHEN f > 1 THEN CAST(f - 1 AS DOUBLE) / f ELSE 0.0 END", 4)} AS repeat_purchase_rate,
  coalesce(preferred, 'Uncategorized') AS preferred_payment_method, {_zero("avg_payment_value")} AS avg_payment_value,
  {_zero("avg_installments")} AS avg_installments, coalesce(installment_ratio, 0.0) AS installment_ratio,
  coalesce(voucher_usage_ratio, 0.0) AS voucher_usage_ratio, {_zero("dd")} AS avg_delivery_days, {_zero("dl")} AS avg_delivery_delay,
  {_ratio("late", "delivered", 4)} AS late_delivery_ratio, {_zero("freight")} AS avg_freight_value, {_zero("avg_review_score")} AS avg_review_score,
  coalesce(positive_review_ratio, 0.0) AS positive_review_ratio, coalesce(negative_review_ratio, 0.0) AS negative_review_ratio,
  coalesce(review_count, 0) AS review_count, rev AS total_revenue,
  {rnd("(rank() OVER (ORDER BY rev) + (count(*) OVER (PARTITION BY rev) - 1) / 2.0) / count(*) OVER () * 100.0")} AS revenue_rank_percentile,
  CASE WHEN rev > (SELECT {quant("rev", 0.75)} FROM base) THEN 'High Value'
       WHEN rev > (SELECT {quant("rev", 0.25)} FROM base) THEN 'Medium Value' ELSE 'Low Value' END AS customer_value_tier,
  {_zero("gap")} AS days_between_orders_mean, {_zero("sd")} AS order_value_std,
  {rnd("rev / greatest(1.0, age / 30.44)")} AS spending_velocity, {rnd("f / greatest(1.0, age / 30.44)", 4)} AS order_frequency_per_month
FROM base""",
    STORE,
)


def store(m):
    c = m.curated()
    return X.feature_store(c.customers, c.orders, c.order_items, c.products, c.payments, c.reviews)


register("feature_store", store, FEATURES_SQL)
for _group, _cols in X.FEATURE_GROUPS.items():
    _name = {
        "customer_profile": "feat_profile",
        "rfm_features": "feat_rfm",
        "purchase_behaviour": "feat_behaviour",
        "payment_features": "feat_payment",
        "delivery_features": "feat_delivery",
        "review_features": "feat_review",
        "revenue_features": "feat_revenue",
        "derived_features": "feat_velocity",
    }[_group]
    _keys = list(dict.fromkeys(["customer_unique_id", *_cols]))
    register(
        _name,
        lambda m, k=tuple(_keys): store(m).select(*k),
        f"SELECT {', '.join(_keys)} FROM ({FEATURES_SQL})",
    )
register(
    "feat_interpurchase",
    lambda m: X.order_profile(m.customers, m.curated().orders).select(
        "customer_unique_id", F.round("days_between_orders_mean", 6).alias("days_between_orders_mean"), F.round("order_value_std", 2).alias("order_value_std")
    ),
    with_roles(
        f"SELECT p.customer_unique_id, {rnd('gap', 6)} AS days_between_orders_mean, {rnd('sd')} AS order_value_std FROM prof p LEFT JOIN gaps USING (customer_unique_id)",
        {"gaps": STORE["gaps"], "prof": STORE["prof"]},
    ),
)
register(
    "feature_metadata",
    lambda m: X.feature_metadata(store(m)).drop("data_type"),
    with_roles(
        "SELECT feature_group, feature, n AS total_customers FROM (VALUES "
        + ", ".join(f"('{g}', '{c}')" for g, cs in X.FEATURE_GROUPS.items() for c in cs)
        + ") f(feature_group, feature) CROSS JOIN (SELECT count(DISTINCT customer_unique_id) AS n FROM customers)"
    ),
)

OBS = f"WHERE {TS} < TIMESTAMP '{CUTOFF}'"
TARGETS = {
    "fut": f"""
  SELECT customer_unique_id, sum(total_items_price) AS target FROM cust_orders
  WHERE {TS} >= TIMESTAMP '{CUTOFF}' AND {TS} < TIMESTAMP '{CUTOFF}' + INTERVAL 90 DAY GROUP BY 1"""
}
TEMPORAL = {
    **TARGETS,
    **habits(OBS),
    "obs": f"""
  SELECT customer_unique_id, min(customer_state) AS customer_state, min(customer_city) AS customer_city, min({TS}) AS first_ts, max({TS}) AS last_ts,
    count(DISTINCT order_id) AS f, CAST(sum(total_items_price) AS DOUBLE) AS price, sum(order_items_qty) AS q, {mmean("total_freight_value")} AS freight,
    avg({days(DEL, TS)}) AS dd, avg({days(DEL, EST)}) AS dl, {count_if(days(DEL, EST) + " > 0")} AS late, count({DEL}) AS delivered
  FROM cust_orders {OBS} GROUP BY 1""",
}
_cut = f"TIMESTAMP '{CUTOFF}'"
TEMPORAL_SQL = f"""SELECT customer_unique_id AS customer_id, customer_unique_id, customer_state, customer_city, {_str("first_ts")} AS first_purchase_date,
  {_str("last_ts")} AS last_purchase_date, {rnd(days(_cut, "last_ts"))} AS obs_recency_days, f AS obs_frequency_orders, price AS obs_monetary_value,
  {_ratio("price", "f", 2)} AS obs_avg_order_value, {rnd(days(_cut, "first_ts"))} AS obs_customer_age_days, {big("q")} AS obs_total_items,
  {_ratio("q", "f", 2)} AS obs_avg_items_per_order, freight AS obs_avg_freight, dd AS obs_avg_delivery_days, dl AS obs_avg_delivery_delay,
  {_ratio("late", "delivered", 4)} AS obs_late_delivery_ratio, {rnd("coalesce(avg_installments, 1)")} AS obs_avg_installments,
  coalesce(preferred, 'credit_card') AS obs_preferred_payment, {rnd("coalesce(avg_review_score, 4)")} AS obs_avg_review_score,
  coalesce(review_count, 0) AS obs_review_count, {rnd("coalesce(target, 0)")} AS target_future_clv,
  CASE WHEN coalesce(target, 0) > 0 THEN 1 ELSE 0 END AS target_repeat_buyer
FROM obs LEFT JOIN pay USING (customer_unique_id) LEFT JOIN pref USING (customer_unique_id) LEFT JOIN rev USING (customer_unique_id)
LEFT JOIN fut USING (customer_unique_id)"""


def temporal(m):
    return X.temporal_features(m.customers, m.orders, m.order_items, m.payments, m.reviews, CUTOFF)


register("temporal_features", temporal, with_roles(TEMPORAL_SQL, TEMPORAL))
register(
    "temporal_targets",
    lambda m: X.temporal_targets(X.person_orders(m.customers, X.with_item_sums(m.orders, m.order_items)), CUTOFF).withColumn(
        "target_future_clv", F.col("target_future_clv").cast("double")
    ),
    with_roles(f"SELECT customer_unique_id, {dbl('target')} AS target_future_clv FROM fut", TARGETS),
)
