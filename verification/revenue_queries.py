from __future__ import annotations

from marketlens.operators import revenue as R
from verification.registry import register
from verification.roles_sql import big, count_if, days, dbl, mmean, msum, pct, rnd, with_roles

RFM = {
    "per_person": """
  SELECT c.customer_unique_id, c.customer_state, count(DISTINCT o.order_id) AS frequency,
         max(o.order_purchase_timestamp) AS last_purchase, sum(p.payment_value) AS monetary,
         """ + mmean("p.payment_value") + """ AS aov
  FROM customers c JOIN m_orders o USING (customer_id) JOIN payments p USING (order_id)
  WHERE o.order_status = 'delivered' GROUP BY 1, 2""",
    "rfm": f"""
  SELECT customer_unique_id, customer_state, {big("floor(" + days("d.ref", "last_purchase") + ")")} AS recency_days,
         frequency, monetary, aov
  FROM per_person CROSS JOIN (SELECT max(order_purchase_timestamp) AS ref FROM m_orders) d""",
}

register(
    "sql_rfm",
    lambda m: R.rfm_profile(m.customers, m.orders, m.payments),
    with_roles(
        f"""SELECT customer_unique_id, customer_state, recency_days, frequency, {rnd("monetary")} AS monetary_value,
  {rnd("aov")} AS avg_order_value,
  CASE WHEN recency_days <= 90 THEN 'Active' WHEN recency_days <= 180 THEN 'At-Risk' ELSE 'Dormant' END AS recency_status,
  CASE WHEN frequency > 1 THEN 'Repeat Buyer' ELSE 'One-Time Buyer' END AS buyer_type FROM rfm""",
        RFM,
    ),
)
register(
    "rfm_quantile_scores",
    lambda m: R.rfm_quantile_scores(R.rfm_profile(m.customers, m.orders, m.payments)),
    with_roles(
        f"""SELECT customer_unique_id, recency_days, frequency, {rnd("monetary")} AS monetary_value,
  ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id) AS r_score,
  ntile(5) OVER (ORDER BY frequency, customer_unique_id) AS f_score,
  ntile(5) OVER (ORDER BY monetary, customer_unique_id) AS m_score FROM rfm""",
        RFM,
    ),
)
register(
    "sql_monthly_growth",
    lambda m: R.monthly_growth(m.customers, m.orders, m.payments),
    with_roles(
        f"""SELECT year_month, total_orders, unique_buyers, {rnd("rev")} AS monthly_revenue, {rnd("aov")} AS monthly_aov,
  {rnd("sum(rev) OVER (ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS cumulative_revenue,
  {rnd(f"CASE WHEN prev IS NULL THEN 0.0 ELSE ({dbl('rev')} - prev) / prev * 100.0 END")} AS mom_growth_pct
FROM (SELECT *, {dbl("lag(rev) OVER (ORDER BY year_month)")} AS prev FROM monthly)""",
        {
            "monthly": f"""
  SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, count(DISTINCT o.order_id) AS total_orders,
         count(DISTINCT customer_unique_id) AS unique_buyers, sum(payment_value) AS rev, {mmean("payment_value")} AS aov
  FROM m_orders o JOIN customers USING (customer_id) JOIN payments p ON o.order_id = p.order_id
  WHERE order_status = 'delivered' GROUP BY 1"""
        },
    ),
)
register(
    "sql_cohort",
    lambda m: R.cohort_retention(m.customers, m.orders),
    with_roles(
        f"""SELECT a.cohort_month, s.n AS initial_cohort_size, a.month_number, count(DISTINCT a.customer_unique_id) AS active_customers,
  {rnd("CAST(count(DISTINCT a.customer_unique_id) AS DOUBLE) / s.n * 100.0")} AS retention_pct
FROM act a JOIN (SELECT cohort_month, count(DISTINCT customer_unique_id) AS n FROM act WHERE month_number = 0 GROUP BY 1) s
  ON a.cohort_month = s.cohort_month GROUP BY 1, 2, 3""",
        {
            "acq": """
  SELECT customer_unique_id, order_purchase_timestamp AS ts,
         min(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id) AS first_ts
  FROM m_orders JOIN customers USING (customer_id) WHERE order_status = 'delivered'""",
            "act": """
  SELECT customer_unique_id, strftime(first_ts, '%Y-%m') AS cohort_month,
         (year(ts) - year(first_ts)) * 12 + month(ts) - month(first_ts) AS month_number FROM acq""",
        },
    ),
)
register(
    "sql_seller_pareto",
    lambda m: R.seller_pareto(m.order_items, m.sellers, m.orders),
    with_roles(
        f"""SELECT seller_id, seller_state, seller_rank, total_orders_handled, {rnd("rev")} AS total_seller_revenue,
  {rnd("CAST(seller_rank AS DOUBLE) / n * 100.0")} AS cumulative_seller_pct,
  {rnd(f"{dbl('cum')} / {dbl('tot')} * 100.0")} AS cumulative_revenue_pct,
  CASE WHEN {dbl('cum')} / {dbl('tot')} <= 0.80 THEN 'Top 80% Revenue Driver' ELSE 'Long-Tail Contributor' END AS pareto_tier
FROM (SELECT *, row_number() OVER w AS seller_rank, count(*) OVER () AS n, sum(rev) OVER () AS tot,
        sum(rev) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM rev WINDOW w AS (ORDER BY rev DESC, seller_id))""",
        {
            "rev": """
  SELECT s.seller_id, s.seller_state, count(DISTINCT i.order_id) AS total_orders_handled, sum(i.price) AS rev
  FROM order_items i JOIN sellers s USING (seller_id) JOIN m_orders o USING (order_id)
  WHERE o.order_status = 'delivered' GROUP BY 1, 2"""
        },
    ),
)
register(
    "sql_sla_state",
    lambda m: R.state_sla(m.customers, m.orders),
    with_roles(
        f"""SELECT customer_state, total_delivered_orders, avg_delivery_days, avg_delay_days, late_deliveries_count,
  {rnd("CAST(ontime AS DOUBLE) / total_delivered_orders * 100.0")} AS sla_achievement_rate_pct,
  row_number() OVER (ORDER BY CAST(ontime AS DOUBLE) / total_delivered_orders DESC, customer_state) AS sla_rank_best_to_worst,
  ntile(4) OVER (ORDER BY avg_delivery_days, customer_state) AS speed_quartile
FROM agg WHERE total_delivered_orders >= 100""",
        {
            "f": f"""
  SELECT customer_state, {days("order_delivered_customer_date", "order_purchase_timestamp")} AS taken,
         {days("order_delivered_customer_date", "order_estimated_delivery_date")} AS late
  FROM m_orders JOIN customers USING (customer_id)
  WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL""",
            "agg": f"""
  SELECT customer_state, count(*) AS total_delivered_orders, {rnd("avg(taken)", 1)} AS avg_delivery_days,
         {rnd("avg(late)", 1)} AS avg_delay_days, {count_if("late > 0")} AS late_deliveries_count,
         {count_if("late <= 0")} AS ontime FROM f GROUP BY 1""",
        },
    ),
)
STATUS = {
    "st": """
  SELECT order_status, count(DISTINCT o.order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
         sum(payment_value) AS gross
  FROM m_orders o LEFT JOIN payments p ON o.order_id = p.order_id GROUP BY 1"""
}
register(
    "sql_status_aggregates",
    lambda m: R.status_aggregates(m.orders, m.payments),
    with_roles(f"SELECT order_status, total_orders, unique_customers, {rnd('gross')} AS gross_payment_value FROM st", STATUS),
)


def _part(cond: str) -> str:
    return msum(f"CASE WHEN {cond} THEN gross END")


register(
    "sql_revenue_reconciliation",
    lambda m: R.revenue_reconciliation(R.status_aggregates(m.orders, m.payments)),
    with_roles(
        f"""SELECT {msum("gross")} AS gross_gmv_all_orders, {_part("order_status = 'delivered'")} AS net_delivered_revenue,
  {_part("order_status IN ('canceled', 'unavailable')")} AS lost_canceled_revenue,
  {_part("order_status NOT IN ('delivered', 'canceled', 'unavailable')")} AS in_flight_order_revenue,
  {count_if("order_status = 'delivered'")} AS delivered_orders_count,
  {count_if("order_status = 'canceled'")} AS canceled_orders_count,
  {count_if("order_status = 'unavailable'")} AS unavailable_orders_count, count(*) AS total_order_records FROM st""",
        STATUS,
    ),
)
register(
    "sql_status_audit",
    lambda m: R.state_cancellations(m.customers, m.orders),
    with_roles(
        """SELECT *, row_number() OVER (ORDER BY cancellation_rate_pct DESC, customer_state) AS cancellation_risk_rank
FROM s WHERE state_total_orders >= 100""",
        {
            "s": f"""
  SELECT customer_state, count(DISTINCT order_id) AS state_total_orders,
         {count_if("order_status = 'delivered'")} AS state_delivered_orders,
         {count_if("order_status = 'canceled'")} AS state_canceled_orders,
         {pct(count_if("order_status = 'canceled'"), "count(DISTINCT order_id)")} AS cancellation_rate_pct
  FROM m_orders JOIN customers USING (customer_id) GROUP BY 1"""
        },
    ),
)
