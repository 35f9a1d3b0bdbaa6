from __future__ import annotations

from marketlens.model import PAYMENT_TYPES
from marketlens.operators import eda_payments as Y
from marketlens.operators import eda_sales as S
from verification.eda_product_customer_queries import CAT_REV, PERF, stats_sql
from verification.registry import register
from verification.roles_sql import big, count_if, dbl, mmean, msum, pct, rnd, with_roles

TS = "order_purchase_timestamp"


def orders_of(m):
    return m.curated().orders


register(
    "eda_revenue_totals",
    lambda m: S.revenue_totals(orders_of(m)),
    with_roles(
        f"""SELECT {msum("order_value")} AS total_revenue, {msum("total_items_price")} AS total_items_revenue,
  {msum("total_freight_value")} AS total_freight_revenue FROM c_orders"""
    ),
)


def _period(section: str, key: str) -> str:
    return f"SELECT '{section}' AS section, {key} AS key, {msum('order_value')} AS revenue FROM c_orders GROUP BY 2"


register(
    "eda_revenue_by_period",
    lambda m: S.revenue_by_period(orders_of(m)),
    with_roles(
        "\nUNION ALL ".join(
            [
                _period("year", f"strftime({TS}, '%Y')"),
                _period("quarter", f"strftime({TS}, '%Y') || 'Q' || quarter({TS})"),
                _period("month", f"strftime({TS}, '%Y-%m')"),
            ]
        )
    ),
)
MONTHLY = {
    "mon": f"SELECT strftime({TS}, '%Y-%m') AS year_month, sum(order_value) AS rev, count(order_id) AS orders FROM c_orders GROUP BY 1"
}
register(
    "eda_mom_growth",
    lambda m: S.revenue_growth(orders_of(m)),
    with_roles(
        f"""SELECT year_month, rev AS revenue, {rnd("CASE WHEN prev > 0 THEN (rev - prev) / prev * 100.0 ELSE 0.0 END")} AS growth_pct
FROM (SELECT year_month, {dbl("rev")} AS rev, lag({dbl("rev")}) OVER (ORDER BY year_month) AS prev FROM mon)""",
        MONTHLY,
    ),
)


def _time(section: str, key: str) -> str:
    return f"SELECT '{section}' AS section, {key} AS key, count(order_id) AS orders FROM m_orders GROUP BY 2"


register(
    "eda_orders_by_time",
    lambda m: S.orders_by_time(m.orders),
    with_roles(
        "\nUNION ALL ".join(
            [
                _time("year", f"strftime({TS}, '%Y')"),
                _time("month", f"strftime({TS}, '%Y-%m')"),
                _time("weekday", f"dayname({TS})"),
                _time("hour", f"strftime({TS}, '%H:00')"),
            ]
        )
    ),
)
register("eda_order_value_stats", lambda m: S.order_value_stats(orders_of(m)), with_roles(stats_sql("order_value", "c_orders")))


def _season(section: str, key: str) -> str:
    return f"""SELECT '{section}' AS section, {key} AS key, {msum("order_value")} AS total_revenue,
  {rnd(mmean("order_value"))} AS average_revenue, count(order_id) AS order_count FROM c_orders GROUP BY 2"""


register(
    "eda_seasonality",
    lambda m: S.seasonality(orders_of(m)),
    with_roles(_season("month", f"monthname({TS})") + "\nUNION ALL " + _season("quarter", f"'Q' || quarter({TS})")),
)
register(
    "eda_daily_spikes",
    lambda m: S.daily_spikes(orders_of(m)),
    with_roles(
        f"""SELECT row_number() OVER (ORDER BY rev DESC, date) AS rank, date, {dbl("rev")} AS daily_revenue, orders AS daily_orders,
  {rnd(dbl("rev") + " / mean")} AS revenue_multiplier_vs_avg,
  CASE WHEN date IN ('2017-11-24', '2017-11-25') THEN 'Black Friday 2017' WHEN date = '2016-11-25' THEN 'Black Friday 2016'
       WHEN date IN ('2017-11-27', '2018-11-26') THEN 'Cyber Monday'
       WHEN {dbl("rev")} >= mean + 3.0 * sigma THEN 'Statistical Spike (>3 Sigma)' ELSE 'Standard Peak' END AS event_context,
  {rnd("mean")} AS average_daily_revenue, {rnd("mean + 3.0 * sigma")} AS spike_threshold_3_sigma
FROM daily CROSS JOIN (SELECT {dbl("sum(rev)")} / count(*) AS mean, stddev_samp({dbl("rev")}) AS sigma FROM daily)
ORDER BY rank LIMIT 10""",
        {
            "daily": f"SELECT strftime({TS}, '%Y-%m-%d') AS date, sum(order_value) AS rev, count(order_id) AS orders FROM c_orders GROUP BY 1"
        },
    ),
)


def _months(ranking: str, way: str) -> str:
    return f"SELECT '{ranking}' AS ranking, row_number() OVER (ORDER BY rev {way}, year_month) AS rank, * FROM ok"


register(
    "eda_best_worst_months",
    lambda m: S.best_worst_months(orders_of(m)),
    with_roles(
        f"""SELECT ranking, rank, year_month, {dbl("rev")} AS revenue, orders AS order_count
FROM ({_months("highest", "DESC")} UNION ALL {_months("lowest", "ASC")}) WHERE rank <= 5""",
        {**MONTHLY, "ok": "SELECT * FROM mon WHERE orders >= 10 OR NOT EXISTS (SELECT 1 FROM mon WHERE orders >= 10)"},
    ),
)
register(
    "eda_best_categories",
    lambda m: S.best_categories(m.order_items, m.curated().products),
    with_roles(
        """SELECT effective_category, revenue, row_number() OVER (ORDER BY revenue DESC, effective_category) AS revenue_rank
FROM cat_rev QUALIFY revenue_rank <= 20""",
        CAT_REV,
    ),
)
register(
    "eda_product_concentration",
    lambda m: S.product_concentration(m.order_items),
    with_roles(
        "SELECT count(*) AS products, "
        + rnd("sum(revenue)")
        + " AS total_revenue, "
        + ", ".join(
            rnd(f"{dbl(f'sum(CASE WHEN rk <= greatest(1, ceil(n * {p / 100.0})) THEN revenue END)')} / {dbl('sum(revenue)')} * 100.0")
            + f" AS top_{p}_percent_share"
            for p in (1, 5, 10, 20)
        )
        + " FROM (SELECT revenue, row_number() OVER (ORDER BY revenue DESC) AS rk, count(*) OVER () AS n FROM perf)",
        PERF,
    ),
)
register(
    "eda_sales_operational",
    lambda m: S.sales_operational(orders_of(m), m.customers),
    with_roles(
        f"""SELECT {rnd(dbl("sum(order_items_qty)") + " / count(*)")} AS average_items_per_order,
  {pct("sum(total_freight_value)", "sum(order_value)")} AS freight_percentage_of_total_revenue,
  {rnd(dbl("sum(order_value)") + " / count(*)")} AS revenue_per_order, {rnd(dbl("sum(order_value)") + " / max(p)")} AS revenue_per_customer,
  max(p) AS total_unique_customers_count
FROM c_orders CROSS JOIN (SELECT count(DISTINCT customer_unique_id) AS p FROM customers)"""
    ),
)

# ---- payments

register(
    "eda_pay_method",
    lambda m: Y.payment_methods(m.payments),
    with_roles(
        f"""SELECT payment_type, count(*) AS transactions, {msum("payment_value")} AS revenue, count(DISTINCT order_id) AS orders,
  {rnd(mmean("payment_value"))} AS average_value FROM payments GROUP BY 1"""
    ),
)
register(
    "eda_pay_installments",
    lambda m: Y.installment_counts(m.payments),
    with_roles(
        f"SELECT {big('payment_installments')} AS installments, count(*) AS transactions, {msum('payment_value')} AS revenue FROM payments GROUP BY 1"
    ),
)
register(
    "eda_pay_installment_means",
    lambda m: Y.installment_means(m.payments),
    with_roles(
        f"""SELECT {rnd(dbl("sum(payment_installments)") + " / count(*)")} AS average_installments,
  {rnd(dbl("sum(payment_installments) FILTER (payment_type = 'credit_card')") + " / count(*) FILTER (payment_type = 'credit_card')")} AS average_installments_credit_card
FROM payments"""
    ),
)
register(
    "eda_pay_split",
    lambda m: Y.installment_split(m.payments),
    with_roles(
        "\nUNION ALL ".join(
            f"""SELECT '{k}' AS kind, {count_if(c)} AS transactions, {pct(count_if(c), "count(*)")} AS transaction_percentage,
  {msum(f"CASE WHEN {c} THEN payment_value END")} AS revenue,
  {pct(f"sum(CASE WHEN {c} THEN payment_value END)", "sum(payment_value)")} AS revenue_percentage FROM payments"""
            for k, c in (("one_time", "payment_installments = 1"), ("installment", "payment_installments > 1"))
        )
    ),
)
register(
    "eda_pay_value_stats",
    lambda m: Y.payment_value_stats(m.payments),
    with_roles(
        f"""SELECT st.*, outlier_count, {pct("outlier_count", "n")} AS outlier_percentage
FROM fences st CROSS JOIN (SELECT {count_if("payment_value < lower_bound OR payment_value > upper_bound")} AS outlier_count
  FROM payments CROSS JOIN fences)""",
        {
            "fences": f"""
  SELECT *, {rnd("q25 - (q75 - q25) * 1.5")} AS lower_bound, {rnd("q75 + (q75 - q25) * 1.5")} AS upper_bound
  FROM (SELECT {msum("payment_value")} AS total_payment_value, sub.* FROM payments
        CROSS JOIN ({stats_sql("payment_value", "payments", drop=("null_count", "std", "skewness"))}) sub GROUP BY ALL)"""
        },
    ),
)
register(
    "eda_pay_multi",
    lambda m: Y.multiple_payments(m.payments),
    with_roles(
        f"""SELECT payments, orders, {big("sum(CASE WHEN payments > 1 THEN orders ELSE 0 END) OVER ()")} AS orders_with_multiple_payments,
  {pct("sum(CASE WHEN payments > 1 THEN orders ELSE 0 END) OVER ()", "sum(orders) OVER ()")} AS multiple_percentage
FROM (SELECT k AS payments, count(*) AS orders FROM per_order GROUP BY 1)""",
        {"per_order": "SELECT order_id, count(payment_sequential) AS k FROM payments GROUP BY 1"},
    ),
)
register(
    "eda_pay_voucher",
    lambda m: Y.voucher_usage(m.payments),
    with_roles(
        f"""SELECT count(*) AS voucher_transaction_count, {msum("payment_value")} AS voucher_total_revenue,
  count(DISTINCT order_id) AS voucher_orders_count,
  {pct("count(DISTINCT order_id)", "(SELECT count(DISTINCT order_id) FROM payments)")} AS voucher_orders_percentage,
  {rnd(mmean("payment_value"))} AS average_voucher_value FROM payments WHERE payment_type = 'voucher'"""
    ),
)
register(
    "eda_pay_dominant",
    lambda m: Y.dominant_method(m.payments),
    with_roles(
        f"""SELECT {count_if("payment_type = 'credit_card'")} AS transaction_count,
  {msum("CASE WHEN payment_type = 'credit_card' THEN payment_value END")} AS revenue,
  {pct(count_if("payment_type = 'credit_card'"), "count(*)")} AS transaction_share_percent,
  {pct("sum(CASE WHEN payment_type = 'credit_card' THEN payment_value END)", "sum(payment_value)")} AS revenue_share_percent
FROM payments"""
    ),
)
_types = ", ".join(msum(f"CASE WHEN payment_type = '{t}' THEN payment_value END") + f" AS {t}" for t in PAYMENT_TYPES)
register(
    "eda_pay_trend",
    lambda m: Y.payment_trend(m.payments, m.orders),
    with_roles(f"SELECT strftime({TS}, '%Y-%m') AS year_month, {_types} FROM payments JOIN m_orders USING (order_id) GROUP BY 1"),
)
_contrib = ", ".join(
    pct(f"coalesce(sum(CASE WHEN payment_type = '{t}' THEN payment_value END), 0)", "sum(payment_value)") + f" AS {t}_contribution_percent"
    for t in PAYMENT_TYPES
)
register(
    "eda_pay_business",
    lambda m: Y.payment_business(m.payments, m.orders, m.customers),
    with_roles(
        f"""SELECT {_contrib},
  {pct("sum(CASE WHEN payment_installments > 1 THEN payment_value END)", "sum(payment_value)")} AS installment_revenue_contribution_percent,
  {rnd(dbl("sum(payment_value)") + " / max(p)")} AS average_payment_per_customer,
  {rnd(dbl("sum(payment_value)") + " / max(o)")} AS average_payment_per_order,
  max(p) AS total_unique_customers_count, max(o) AS total_unique_orders_count
FROM payments CROSS JOIN (SELECT count(DISTINCT customer_unique_id) AS p FROM customers)
CROSS JOIN (SELECT count(DISTINCT order_id) AS o FROM m_orders)"""
    ),
)
