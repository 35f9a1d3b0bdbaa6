"""SQL text of the marketplace roles, for the oracle side. Written apart from the Spark views."""

from __future__ import annotations

import re

D = "DECIMAL(18,2)"

ROLES = {
    "customers": """
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, c_custkey % 100000 AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "m_orders": """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) AS order_approved_at,
         s.first_ship AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date,
         o_orderdate + INTERVAL 45 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                         FROM lineitem GROUP BY 1) s ON o_orderkey = s.l_orderkey""",
    "order_items": f"""
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS {D}) AS price,
         CAST(CAST(l_extendedprice AS {D}) * CAST(l_tax AS DECIMAL(4,2)) AS {D}) AS freight_value
  FROM lineitem""",
    "payments": f"""
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
         CAST(l_quantity AS INTEGER) % 11 AS payment_installments,
         CAST(CAST(l_extendedprice AS {D}) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS {D})
           AS payment_value
  FROM lineitem""",
    "reviews": """
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
         CAST(1 + (7 * o_orderkey + o_custkey) % 5 AS INTEGER) AS review_score,
         CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority END AS review_comment_title,
         d.text AS review_comment_message,
         o_orderdate + INTERVAL 60 DAY AS review_creation_date,
         o_orderdate + INTERVAL 62 DAY AS review_answer_timestamp
  FROM orders LEFT JOIN documents d ON o_orderkey = d.doc_id""",
    "translations": """
  SELECT p_type AS product_category_name, min(lower(p_type)) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO' GROUP BY p_type""",
    "products": """
  SELECT p_partkey AS product_id, p_type AS product_category_name,
         CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
         CAST(length(p_brand) AS DOUBLE) AS product_description_lenght,
         CAST(p_size % 6 AS DOUBLE) AS product_photos_qty, CAST(p_size AS DOUBLE) AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size % 7 + 1 AS DOUBLE) AS product_height_cm,
         CAST(p_size % 5 + 1 AS DOUBLE) AS product_width_cm
  FROM part""",
    "c_products": """
  SELECT p.*, t.product_category_name_english AS category_name_english,
         coalesce(t.product_category_name_english, p.product_category_name, 'Uncategorized') AS effective_category,
         product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
  FROM products p LEFT JOIN translations t USING (product_category_name)""",
    "sellers": """
  SELECT s_suppkey AS seller_id, s_suppkey % 100000 AS seller_zip_code_prefix, s_name AS seller_city,
         n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "item_sums": f"""
  SELECT order_id, count(order_item_id) AS order_items_qty, CAST(sum(price) AS {D}) AS total_items_price,
         CAST(sum(freight_value) AS {D}) AS total_freight_value
  FROM order_items GROUP BY order_id""",
    "c_orders": f"""
  SELECT o.*, @days(order_delivered_customer_date, order_estimated_delivery_date)@ AS delivery_delay_days,
         @days(order_delivered_carrier_date, order_purchase_timestamp)@ AS fulfillment_days,
         @days(order_delivered_customer_date, order_purchase_timestamp)@ AS delivery_days,
         order_status = 'delivered' AS is_delivered,
         coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late_delivery,
         coalesce(order_items_qty, 0) AS order_items_qty,
         CAST(coalesce(total_items_price, 0) AS {D}) AS total_items_price,
         CAST(coalesce(total_freight_value, 0) AS {D}) AS total_freight_value,
         CAST(coalesce(total_items_price, 0) + coalesce(total_freight_value, 0) AS {D}) AS order_value
  FROM m_orders o LEFT JOIN item_sums USING (order_id)""",
    "cust_orders": """
  SELECT o.*, c.customer_unique_id, c.customer_state, c.customer_city
  FROM c_orders o JOIN customers c USING (customer_id)""",
    "item_cats": """
  SELECT i.*, coalesce(p.effective_category, 'Uncategorized') AS effective_category, p.product_weight_g,
         p.product_volume_cm3
  FROM order_items i LEFT JOIN c_products p USING (product_id)""",
}


def rnd(expr: str, digits: int = 2) -> str:
    """Half-up rounding of a double's shortest decimal form, as Spark's round does."""
    return f"CAST(TRY_CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def days(end: str, start: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / 86400000000.0)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def msum(expr: str, digits: int = 2) -> str:
    return rnd(f"coalesce(sum({expr}), 0)", digits)


def mmean(expr: str) -> str:
    """Unrounded mean of a decimal column through its exact sum."""
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END * 100.0", digits)


def count_if(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def quant(expr: str, p: float) -> str:
    return f"quantile_cont(CAST({expr} AS DOUBLE), {p})"


def _expand(text: str) -> str:
    return re.sub(r"@days\((\w+), (\w+)\)@", lambda m: rnd(days(m[1], m[2])), text)


def with_roles(body: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with its own CTEs and exactly the role CTEs that it (transitively) reads."""
    own = ctes or {}
    need: list[str] = []

    def visit(text: str) -> None:
        for name in ROLES:
            if re.search(rf"\b{name}\b", text) and name not in need and name not in own:
                visit(ROLES[name])
                if name not in need:
                    need.append(name)

    for text in [*own.values(), body]:
        visit(text)
    # c_orders mentions columns named like nothing else; self reference is impossible by design.
    parts = [f"{n} AS ({_expand(ROLES[n])})" for n in need] + [f"{n} AS ({t})" for n, t in own.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
