from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.model import ORDER_STATUSES
from marketlens.operators import advanced as A
from marketlens.operators import hypotheses as H
from verification.registry import register
from verification.roles_sql import big, count_if, days, dbl, mmean, msum, pct, rnd, with_roles

SPAN = 79  # months between the first and the last purchase in the test data
FIVE = [f"NATION_{i}" for i in (1, 2, 3, 4, 5)]

COHORT = {
    "acq": """
  SELECT customer_unique_id, order_purchase_timestamp AS ts,
         min(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id) AS first_ts
  FROM m_orders JOIN customers USING (customer_id)""",
    "cells": """
  SELECT strftime(first_ts, '%Y-%m') AS cohort_month,
         (year(ts) - year(first_ts)) * 12 + month(ts) - month(first_ts) AS i, count(DISTINCT customer_unique_id) AS n
  FROM acq GROUP BY 1, 2""",
    "matrix": "SELECT cohort_month, "
    + ", ".join(f"CAST(coalesce(sum(n) FILTER (i = {k}), 0) AS BIGINT) AS m{k}" for k in range(SPAN + 1))
    + " FROM cells GROUP BY 1",
}


def matrix(m):
    return A.cohort_matrix(m.customers, m.orders, A.cohort_span(m.orders))


register("cohort_matrix", matrix, with_roles("SELECT * FROM matrix", COHORT))
register(
    "cohort_retention_pct",
    lambda m: A.cohort_retention_pct(matrix(m)),
    with_roles(
        "SELECT cohort_month, "
        + ", ".join(rnd(rnd(f"CASE WHEN m0 > 0 THEN m{k}::DOUBLE / m0 ELSE 0 END", 4) + " * 100.0") + f" AS m{k}" for k in range(SPAN + 1))
        + " FROM matrix",
        COHORT,
    ),
)

DELAY = days("order_delivered_customer_date", "order_estimated_delivery_date")


def _seller_sql(reviews: str) -> str:
    return f"""SELECT seller_id, {msum("price")} AS total_revenue, count(order_item_id) AS total_items_sold,
  count(DISTINCT order_id) AS total_orders, count(DISTINCT product_id) AS unique_products,
  {rnd(mmean("price"))} AS avg_item_price, {rnd(mmean("freight_value"))} AS avg_freight,
  {rnd("coalesce(avg(delay), 0)")} AS avg_delivery_delay, {count_if("delay > 0")} AS late_orders_count,
  {rnd("coalesce(avg(review_score), 4.0)")} AS avg_review_score,
  {rnd(dbl(count_if("delay > 0")) + " / count(DISTINCT order_id)", 4)} AS late_delivery_rate
FROM order_items LEFT JOIN (SELECT order_id, {DELAY} AS delay FROM m_orders) USING (order_id)
LEFT JOIN ({reviews}) USING (order_id) GROUP BY 1"""


register(
    "seller_performance",
    lambda m: A.seller_performance(m.order_items, m.orders, m.reviews),
    with_roles(_seller_sql("SELECT order_id, review_score FROM reviews")),
)
register(
    "seller_performance_dedup",
    lambda m: A.seller_performance_dedup(m.order_items, m.orders, m.reviews),
    with_roles(_seller_sql("SELECT order_id, avg(review_score) AS review_score FROM reviews GROUP BY 1")),
)


def _pareto_sql(entity: str) -> str:
    shares = ", ".join(
        rnd(f"max(CASE WHEN rk * 100 <= n * {p} THEN {dbl('cum')} / {dbl('tot')} * 100.0 END)") + f" AS top_{p}_percent_revenue_share"
        for p in (10, 20, 50)
    )
    return f"""SELECT count(*) AS {entity}, {rnd("max(tot)")} AS total_revenue, {shares}
FROM (SELECT rev, row_number() OVER w AS rk, count(*) OVER () AS n, sum(rev) OVER () AS tot,
        sum(rev) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM ent WINDOW w AS (ORDER BY rev DESC, id))"""


register(
    "pareto_customers",
    lambda m: A.pareto_customers(m.customers, m.orders, m.order_items),
    with_roles(
        _pareto_sql("total_customers"),
        {
            "ent": """
  SELECT customer_unique_id AS id, coalesce(sum(price), 0) AS rev
  FROM m_orders LEFT JOIN order_items USING (order_id) JOIN customers USING (customer_id) GROUP BY 1"""
        },
    ),
)
register(
    "pareto_sellers",
    lambda m: A.pareto_sellers(m.order_items),
    with_roles(_pareto_sql("total_sellers"), {"ent": "SELECT seller_id AS id, sum(price) AS rev FROM order_items GROUP BY 1"}),
)

_lost = "order_status IN ('canceled', 'unavailable')"
register(
    "order_status_audit",
    lambda m: A.order_status_audit(m.orders, m.payments),
    with_roles(
        "SELECT count(*) AS total_orders, "
        + ", ".join(f"{count_if(f'order_status = {s!r}')} AS {s}_orders" for s in ORDER_STATUSES)
        + f""", {msum("paid")} AS gross_gmv_all_orders, {msum("CASE WHEN order_status = 'delivered' THEN paid END")} AS net_delivered_revenue,
  {msum(f"CASE WHEN {_lost} THEN paid END")} AS lost_canceled_revenue,
  {msum(f"CASE WHEN NOT ({_lost}) AND order_status <> 'delivered' THEN paid END")} AS in_flight_revenue,
  {pct(count_if(_lost), "count(*)")} AS cancellation_rate_pct
FROM m_orders LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM payments GROUP BY 1) USING (order_id)"""
    ),
)

# Tail of the standard normal by Simpson's rule; enough for six decimals of a p-value.
TAIL = """(SELECT sum(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-0.5 * (z + i * 0.003) ** 2))
  * 0.003 / 3 / sqrt(2 * pi()) FROM range(4001) t(i))"""


def _mw_sql(names: tuple[str, str, str, str], two_sided: bool) -> dict[str, str]:
    best = "greatest(u, n1 * n2 - u)" if two_sided else "n1 * n2 - u"
    return {
        "rk": """
  SELECT v, first, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS r FROM obs""",
        "mw": """
  SELECT count(*) FILTER (first)::DOUBLE AS n1, count(*) FILTER (NOT first)::DOUBLE AS n2,
         sum(r::DOUBLE) FILTER (first) AS rs, avg(v::DOUBLE) FILTER (first) AS m1, avg(v::DOUBLE) FILTER (NOT first) AS m2,
         (SELECT sum(c ** 3 - c) FROM (SELECT count(*)::DOUBLE AS c FROM obs GROUP BY v)) AS ties FROM rk""",
        "st": f"""
  SELECT *, ({best} - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z
  FROM (SELECT *, rs - n1 * (n1 + 1) / 2 AS u FROM mw)""",
        "sized": """
  SELECT *, least(n1, n2)::BIGINT AS k, greatest(n1, n2)::BIGINT AS m,
         ties = 0 AND least(n1, n2) > 0 AND least(n1, n2) <= 8 AND n1 * n2 <= 20000 AS small FROM st""",
        **_orders_sql(),
        "res": f"""
  SELECT *, CASE WHEN small THEN least(1.0, {2 if two_sided else 1} * (SELECT sum(c) FILTER (d8.u <= {"least(s.u, n1 * n2 - s.u)" if two_sided else "s.u"})::DOUBLE / sum(c)::DOUBLE FROM d8))
    ELSE least(1.0, {2 if two_sided else 1} * {TAIL}) END AS p FROM sized s""",
    }


def _orders_sql() -> dict[str, str]:
    """Orders of the rows per U: for i up to k, multiply by 1 - q^(m + i) and divide by 1 - q^i."""
    out = {"d0": "SELECT u, CASE WHEN u = 0 THEN 1 ELSE 0 END::HUGEINT AS c FROM (SELECT unnest(range(CASE WHEN small THEN k * m + 1 ELSE 0 END)) AS u FROM sized)"}
    for i in range(1, 9):
        out[f"d{i}"] = f"""
  SELECT u, CASE WHEN {i} <= k THEN sum(c - coalesce(p, 0)) OVER (PARTITION BY u % {i} ORDER BY u) ELSE c END AS c
  FROM (SELECT a.u, a.c, b.c AS p, k FROM d{i - 1} a CROSS JOIN sized LEFT JOIN d{i - 1} b ON b.u = a.u - m - {i})"""
    return out


def _mw_select(names: tuple[str, str, str, str]) -> str:
    a, b, c, d = names
    return f"""SELECT {big("n1")} AS {a}, {big("n2")} AS {b}, {rnd("m1")} AS {c}, {rnd("m2")} AS {d}, u AS u_statistic, {rnd("p", 6)} AS p_value,
  {rnd("1 - 2 * u / (n1 * n2)", 4)} AS effect_size_rank_biserial, p < 0.05 AS statistically_significant,
  CASE WHEN small THEN 'exact' ELSE 'asymptotic' END AS method FROM res"""


def _rounded_p(df):
    return df.withColumn("p_value", F.round("p_value", 6))


_review = ("late_orders", "ontime_orders", "late_mean", "ontime_mean")
register(
    "test_mannwhitney_delay_review",
    lambda m: _rounded_p(H.delay_against_review(m.orders, m.reviews)),
    with_roles(
        _mw_select(_review),
        {
            "obs": f"""
  SELECT review_score AS v, {DELAY} > 0 AS first FROM m_orders JOIN reviews USING (order_id)
  WHERE order_delivered_customer_date IS NOT NULL""",
            **_mw_sql(_review, False),
        },
    ),
)
_spend = ("repeat_buyers", "single_buyers", "repeat_mean_aov", "single_mean_aov")
register(
    "test_mannwhitney_spend",
    lambda m: _rounded_p(H.repeat_against_single_spend(m.customers, m.orders, m.order_items)),
    with_roles(
        _mw_select(_spend),
        {
            "obs": f"""
  SELECT customer_unique_id, {dbl("coalesce(sum(price), 0)")} / count(DISTINCT order_id) AS v, count(DISTINCT order_id) > 1 AS first
  FROM m_orders LEFT JOIN order_items USING (order_id) JOIN customers USING (customer_id) GROUP BY 1""",
            **_mw_sql(_spend, True),
        },
    ),
)
_means = ", ".join(f"{rnd(f'avg(v) FILTER (g = {s!r})')} AS mean_{i + 1}" for i, s in enumerate(FIVE))
register(
    "test_kruskal_states",
    lambda m: H.state_delays(m.customers, m.orders, FIVE)
    .withColumn("h_statistic", F.round("h_statistic", 6))
    .withColumn("p_value", F.round("p_value", 6)),
    with_roles(
        f"""SELECT {big("n")} AS observations, {rnd("h", 6)} AS h_statistic, {rnd("exp(-h / 2) * (1 + h / 2)", 6)} AS p_value,
  exp(-h / 2) * (1 + h / 2) < 0.05 AS statistically_significant, * EXCLUDE (n, h)
FROM (SELECT n, (12 / (n * (n + 1)) * (SELECT sum(s * s / c) FROM (SELECT g, sum(r) AS s, count(*) AS c FROM rk GROUP BY g)) - 3 * (n + 1))
    / (1 - ties / (n ** 3 - n)) AS h, {', '.join(f'mean_{i + 1}' for i in range(5))}
  FROM (SELECT count(*)::DOUBLE AS n, (SELECT sum(c ** 3 - c) FROM (SELECT count(*)::DOUBLE AS c FROM obs GROUP BY v)) AS ties, {_means} FROM obs))""",
        {
            "obs": f"""
  SELECT customer_state AS g, {DELAY} AS v FROM m_orders JOIN customers USING (customer_id)
  WHERE order_delivered_customer_date IS NOT NULL AND customer_state IN ({', '.join(repr(s) for s in FIVE)})""",
            "rk": "SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS r FROM obs",
        },
    ),
)
