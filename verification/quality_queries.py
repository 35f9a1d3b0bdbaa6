from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.model import PIPELINE_DATASETS, RULES
from marketlens.operators import quality as Q
from verification import dirty
from verification.registry import register
from verification.roles_sql import big, count_if, rnd, with_roles

TABLE = {"orders": "m_orders"}  # SQL name of a role where it differs


def sql_name(role: str) -> str:
    return TABLE.get(role, role)


def raw_tables(m) -> dict[str, DataFrame]:
    return {n: m.as_dict()[n] for n in PIPELINE_DATASETS}


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def union_reports(frames):
    return reduce(DataFrame.unionByName, frames)


# ---- schema checks


def schema_check(finder):
    def query(m):
        tables = raw_tables(m)
        rows = [
            tables[n].agg(
                F.lit(n).alias("dataset"),
                F.count(F.lit(1)).alias("rows"),
                F.lit(len(finder(tables[n], RULES[n]))).cast("long").alias("violations"),
            )
            for n in PIPELINE_DATASETS
        ]
        return union_reports(rows)

    return query


_no_violation = with_roles(
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM {sql_name(n)}" for n in PIPELINE_DATASETS
    )
)
register("dq_required_cols", schema_check(Q.missing_columns), _no_violation)
register("dq_unexpected_cols", schema_check(Q.unexpected_columns), _no_violation)

# Numeric ids where the rules say text, and dates that are already timestamps.
MISMATCHES = {"customers": 2, "orders": 7, "order_items": 4, "products": 1, "payments": 1, "reviews": 4, "translations": 0}
register(
    "dq_dtypes",
    schema_check(Q.type_mismatches),
    with_roles(
        "\nUNION ALL ".join(
            f"SELECT '{n}' AS dataset, count(*) AS rows, CAST({k} AS BIGINT) AS violations FROM {sql_name(n)}" for n, k in MISMATCHES.items()
        )
    ),
)


# ---- keys


def _key_sql(role: str, source: str | None = None) -> str:
    keys = ", ".join(RULES[role].key)
    any_null = " OR ".join(f"{k} IS NULL" for k in RULES[role].key)
    return f"""SELECT '{role}' AS dataset, {big("coalesce(sum(CASE WHEN n > 1 THEN n END), 0)")} AS duplicate_rows,
  {count_if("n > 1")} AS duplicate_keys, {big("coalesce(sum(n - 1), 0)")} AS surplus_rows,
  {big(f"coalesce(sum(CASE WHEN {any_null} THEN n END), 0)")} AS null_key_rows
FROM (SELECT {keys}, count(*) AS n FROM {source or sql_name(role)} GROUP BY {keys})"""


def _keys(roles):
    def query(m):
        t = raw_tables(m)
        return union_reports(
            [Q.key_violations(t[r], list(RULES[r].key)).select(F.lit(r).alias("dataset"), "*") for r in roles]
        )

    return query


PK = [n for n in PIPELINE_DATASETS if RULES[n].primary_key]
CK = [n for n in PIPELINE_DATASETS if RULES[n].composite_key]
register("dq_pk_unique", _keys(PK), with_roles("\nUNION ALL ".join(_key_sql(r) for r in PK)))
register("dq_composite_unique", _keys(CK), with_roles("\nUNION ALL ".join(_key_sql(r) for r in CK)))


# ---- generic row checks, per column


def _violations(check: str):
    def query(m):
        t = raw_tables(m)
        return union_reports([Q.column_violations(n, t[n]) for n in PIPELINE_DATASETS]).filter(F.col("check") == check)

    return query


def _column_sql(check: str, source) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS dataset, '{check}' AS \"check\", '{c}' AS \"column\", {count_if(cond)} AS violations FROM {source(n)}"
        for n, cols in CONDITIONS[check].items()
        for c, cond in cols.items()
    )


def _bound_sql(c: str, b) -> str:
    tests = [f"{c} < {b.low}"] if b.low is not None else []
    tests += [f"{c} > {b.high}"] if b.high is not None else []
    return " OR ".join(tests)


CONDITIONS = {
    "nullable_fields": {n: {c: f"{c} IS NULL" for c in RULES[n].required} for n in PIPELINE_DATASETS},
    "enum_fields": {n: {c: f"{c} NOT IN ({quoted(v)})" for c, v in RULES[n].enums.items()} for n in PIPELINE_DATASETS},
    "numeric_constraints": {n: {c: _bound_sql(c, b) for c, b in RULES[n].bounds.items()} for n in PIPELINE_DATASETS},
    "date_fields": {
        n: {c: f"{c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS TIMESTAMP) IS NULL" for c in RULES[n].date_fields}
        for n in PIPELINE_DATASETS
    },
}
for _name, _check in {
    "dq_nulls": "nullable_fields",
    "dq_enum": "enum_fields",
    "dq_numeric": "numeric_constraints",
    "dq_dates": "date_fields",
}.items():
    register(_name, _violations(_check), with_roles(_column_sql(_check, sql_name)))


# ---- domain checks

SEQUENCE = [
    "order_purchase_timestamp > order_approved_at",
    "order_approved_at > order_delivered_carrier_date",
    "order_delivered_carrier_date > order_delivered_customer_date",
]
DOMAIN = {
    "dq_customer_state": ("customers", "customers_state_code", [f"coalesce(customer_state NOT IN ({quoted(Q.STATES)}), TRUE)"]),
    "dq_customer_zip": (
        "customers",
        "customers_zip_bounds",
        ["customer_zip_code_prefix IS NULL OR customer_zip_code_prefix NOT BETWEEN 0 AND 99999"],
    ),
    "dq_order_status": ("orders", "orders_status", [f"coalesce(order_status NOT IN ({quoted(Q.ORDER_STATUSES)}), TRUE)"]),
    "dq_order_ts_sequence": ("orders", "orders_timestamp_sequence", SEQUENCE),
    "dq_product_dims": (
        "products",
        "products_dimensions",
        ["product_weight_g < 0 OR product_length_cm < 0 OR product_height_cm < 0 OR product_width_cm < 0"],
    ),
    "dq_payment_value": ("payments", "payments_value", ["payment_value IS NULL OR payment_value < 0"]),
    "dq_payment_installments": (
        "payments",
        "payments_installments",
        ["payment_installments IS NULL OR payment_installments < 0"],
    ),
    "dq_review_score": ("reviews", "reviews_score_range", ["review_score IS NULL OR review_score NOT BETWEEN 1 AND 5"]),
}


def _domain_sql(role: str, check: str, conds: list[str], source: str) -> str:
    found = " + ".join(count_if(c) for c in conds)
    return f"SELECT '{check}' AS \"check\", count(*) AS \"rows\", {found} AS violations FROM {source}"


def _domain(role: str, check: str, tables=raw_tables):
    def query(m):
        df = tables(m)[role]
        hits = next(c for c in Q.domain_checks(role, df) if c.name == check).hits
        counts = [F.count(F.when(h, 1)) for h in hits]
        return df.agg(
            F.lit(check).alias("check"), F.count(F.lit(1)).alias("rows"), reduce(lambda a, b: a + b, counts).alias("violations")
        )

    return query


for _name, (_role, _check, _conds) in DOMAIN.items():
    register(_name, _domain(_role, _check), with_roles(_domain_sql(_role, _check, _conds, sql_name(_role))))

register(
    "dq_fk_orders_customer",
    lambda m: Q.orphan_count(m.orders, "customer_id", m.customers),
    with_roles("SELECT count(*) AS violations FROM m_orders WHERE customer_id NOT IN (SELECT customer_id FROM customers)"),
)
register(
    "dq_product_translation",
    lambda m: Q.unknown_categories(m.products, m.translations).groupBy("product_category_name").agg(F.count("*").alias("products")),
    with_roles(
        """SELECT product_category_name, count(*) AS products FROM products
WHERE product_category_name NOT IN (SELECT product_category_name FROM translations) GROUP BY 1"""
    ),
)

# ---- whole reports

FK_SQL = {
    "orders.customer_id->customers": ("m_orders", "customer_id", "customers"),
    "order_items.order_id->orders": ("order_items", "order_id", "m_orders"),
    "order_items.product_id->products": ("order_items", "product_id", "products"),
    "payments.order_id->orders": ("payments", "order_id", "m_orders"),
    "reviews.order_id->orders": ("reviews", "order_id", "m_orders"),
}


def _audit_sql(rows: list[tuple[str, str]]) -> str:
    body = "\nUNION ALL ".join(f"SELECT '{label}' AS audit, ({n}) AS violations" for label, n in rows)
    return with_roles(
        f"SELECT audit, violations, CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM ({body})"
    )


register(
    "dq_fk_audit",
    lambda m: Q.foreign_key_audit(raw_tables(m)),
    _audit_sql(
        [
            (label, f"SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})")
            for label, (child, key, parent) in FK_SQL.items()
        ]
    ),
)
register(
    "dq_null_audit",
    lambda m: Q.null_audit({n: raw_tables(m)[n] for n in PIPELINE_DATASETS}),
    _audit_sql(
        [
            (f"{n}_null_keys", f"SELECT count(*) FROM {sql_name(n)} WHERE " + " OR ".join(f"{k} IS NULL" for k in RULES[n].key))
            for n in PIPELINE_DATASETS
        ]
    ),
)
register(
    "dq_pk_audit",
    lambda m: Q.key_audit({n: raw_tables(m)[n] for n in PIPELINE_DATASETS}),
    _audit_sql(
        [
            (
                f"{n}_duplicate_keys",
                f"SELECT count(*) FROM (SELECT 1 FROM {sql_name(n)} GROUP BY {', '.join(RULES[n].key)} HAVING count(*) > 1)",
            )
            for n in PIPELINE_DATASETS
        ]
    ),
)

INVALID = {
    "customers": f"""coalesce(customer_state NOT IN ({quoted(Q.STATES)}), TRUE) OR customer_zip_code_prefix NOT BETWEEN 0 AND 99999""",
    "orders": " OR ".join(f"coalesce({s}, FALSE)" for s in SEQUENCE),
    "order_items": "count(*) OVER (PARTITION BY order_id, order_item_id) > 1",
    "payments": "count(*) OVER (PARTITION BY order_id, payment_sequential) > 1",
    "products": "product_category_name IS NULL AND product_id IS NULL",
    "reviews": "review_score NOT BETWEEN 1 AND 5",
    "translations": "product_category_name IS NULL",
}
register(
    "dq_invalid_rows",
    lambda m: union_reports([Q.invalid_row_counts(n, raw_tables(m)[n], raw_tables(m)) for n in PIPELINE_DATASETS]),
    with_roles(
        "\nUNION ALL ".join(
            f"""SELECT '{n}' AS dataset, count(*) AS total_rows, {count_if("bad")} AS invalid_rows,
  {rnd(f"CAST({count_if('bad')} AS DOUBLE) / count(*)", 6)} AS error_rate FROM (SELECT ({INVALID[n]}) AS bad FROM {sql_name(n)})"""
            for n in PIPELINE_DATASETS
        )
    ),
)
_REPORT = [
    ("required_columns", "CRITICAL", "0"),
    ("unexpected_columns", "WARNING", "0"),
    ("column_types", "INFO", str(MISMATCHES["orders"])),
    ("primary_key_nulls", "CRITICAL", "SELECT count(*) FROM m_orders WHERE order_id IS NULL"),
    ("primary_key_uniqueness", "ERROR", "SELECT count(*) - count(DISTINCT order_id) FROM m_orders"),
    ("nullable_fields", "ERROR", "SELECT " + " + ".join(count_if(f"{c} IS NULL") for c in RULES["orders"].required) + " FROM m_orders"),
    ("enum_fields", "ERROR", f"SELECT {count_if(f'order_status NOT IN ({quoted(Q.ORDER_STATUSES)})')} FROM m_orders"),
    ("numeric_constraints", "ERROR", "0"),
    ("date_fields", "ERROR", "0"),
    ("orders_status", "ERROR", f"SELECT {count_if(DOMAIN['dq_order_status'][2][0])} FROM m_orders"),
    ("orders_timestamp_sequence", "WARNING", "SELECT " + " + ".join(count_if(c) for c in SEQUENCE) + " FROM m_orders"),
    ("orders_customer_foreign_key", "ERROR", "SELECT count(*) FROM m_orders WHERE customer_id NOT IN (SELECT customer_id FROM customers)"),
]
register(
    "dq_report",
    lambda m: Q.quality_report("orders", m.orders, raw_tables(m)),
    with_roles(
        """SELECT dataset, check_order, "check", violations, CASE WHEN violations = 0 THEN 'INFO' ELSE sev END AS severity,
  CASE WHEN violations = 0 THEN 'PASSED' WHEN sev IN ('INFO', 'WARNING') THEN 'WARNING' ELSE 'FAILED' END AS status FROM ("""
        + "\nUNION ALL ".join(
            f"SELECT 'orders' AS dataset, CAST({i + 1} AS BIGINT) AS check_order, '{c}' AS \"check\", '{sev}' AS sev, CAST(({q if q.startswith('SELECT') else 'SELECT ' + q}) AS BIGINT) AS violations"
            for i, (c, sev, q) in enumerate(_REPORT)
        )
        + ")"
    ),
)
# What can fail in the given tables: customer states, repeated item and payment keys (FAILED),
# order date sequences and untranslated categories (WARNING). Numeric ids where the rules say
# text are a type mismatch, which alone is a WARNING: every dataset but translations has one.
_status = {
    "customers": ("FAILED", f"SELECT count(*) FROM customers WHERE {INVALID['customers']}"),
    "order_items": ("FAILED", "SELECT count(*) FROM (SELECT 1 FROM order_items GROUP BY order_id, order_item_id HAVING count(*) > 1)"),
    "payments": ("FAILED", "SELECT count(*) FROM (SELECT 1 FROM payments GROUP BY order_id, payment_sequential HAVING count(*) > 1)"),
    "orders": ("WARNING", f"SELECT count(*) FROM m_orders WHERE {INVALID['orders']}"),
    "products": (
        "WARNING",
        "SELECT count(*) FROM products WHERE product_category_name NOT IN (SELECT product_category_name FROM translations)",
    ),
    "reviews": ("FAILED", "SELECT count(*) FROM reviews WHERE review_score NOT BETWEEN 1 AND 5"),
    "translations": ("FAILED", "SELECT count(*) FROM translations WHERE product_category_name IS NULL"),
}
STATUS_SQL = "\nUNION ALL ".join(
    f"SELECT '{n}' AS dataset, CASE WHEN ({q}) > 0 THEN '{bad}' ELSE '{'PASSED' if n == 'translations' else 'WARNING'}' END AS status"
    for n, (bad, q) in _status.items()
)
register(
    "dq_batch",
    lambda m: Q.quality_summary(Q.quality_batch(raw_tables(m))).select("dataset", "status"),
    with_roles(STATUS_SQL),
)
register(
    "dq_circuit_breaker",
    lambda m: Q.overall_status(Q.quality_summary(Q.quality_batch(raw_tables(m)))),
    with_roles(
        f"""SELECT CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'WARNING') THEN 'WARNING' ELSE 'PASSED' END AS overall_status,
  count(*) AS total_datasets, {count_if("status <> 'FAILED'")} AS passed_datasets, {count_if("status = 'FAILED'")} AS failed_datasets,
  (SELECT count(*) FROM m_orders WHERE order_id IS NULL) + (SELECT count(*) FROM customers WHERE customer_id IS NULL) = 0 AS can_continue
FROM ({STATUS_SQL})"""
    ),
)
register(
    "dq_quarantine",
    lambda m: Q.split_quarantine("orders", m.orders, raw_tables(m))[1].select("order_id", F.concat_ws(",", "_violations").alias("violations")),
    with_roles(
        "SELECT order_id, 'orders_timestamp_sequence' AS violations FROM m_orders WHERE "
        + " OR ".join(f"coalesce({s}, FALSE)" for s in SEQUENCE)
    ),
)

# ---- the same checks on data with violations of each kind

DIRT = dirty.role_sql({n: sql_name(n) for n in PIPELINE_DATASETS})


def dirty_tables(m) -> dict[str, DataFrame]:
    return dirty.roles(raw_tables(m))


def _dirty_name(role: str) -> str:
    return f"d_{role}"


register(
    "dq_dirty_columns",
    lambda m: union_reports([Q.column_violations(n, t) for n, t in dirty_tables(m).items()]).filter(F.col("check").isin(*CONDITIONS)),
    with_roles("\nUNION ALL ".join(_column_sql(c, _dirty_name) for c in CONDITIONS), DIRT),
)
register(
    "dq_dirty_domain",
    lambda m: union_reports([_domain(r, c, dirty_tables)(m) for r, c, _ in DOMAIN.values()]),
    with_roles("\nUNION ALL ".join(_domain_sql(r, c, conds, _dirty_name(r)) for r, c, conds in DOMAIN.values()), DIRT),
)
register(
    "dq_dirty_keys",
    lambda m: union_reports(
        [Q.key_violations(dirty_tables(m)[r], list(RULES[r].key)).select(F.lit(r).alias("dataset"), "*") for r in [*PK, *CK]]
    ),
    with_roles("\nUNION ALL ".join(_key_sql(r, _dirty_name(r)) for r in [*PK, *CK]), DIRT),
)
register(
    "dq_dirty_orphans",
    lambda m: Q.orphan_count(dirty_tables(m)["orders"], "customer_id", m.customers),
    with_roles(
        # An order without a customer has no parent either.
        "SELECT count(*) AS violations FROM d_orders o WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = o.customer_id)",
        {"d_orders": DIRT["d_orders"]},
    ),
)
register(
    "dq_dirty_breaker",
    lambda m: Q.overall_status(Q.quality_summary(Q.quality_batch(dirty_tables(m)))).select("can_continue"),
    with_roles(
        "SELECT (SELECT count(*) FROM d_customers WHERE customer_id IS NULL) + (SELECT count(*) FROM d_orders WHERE order_id IS NULL) = 0 AS can_continue",
        {n: DIRT[n] for n in ("d_customers", "d_orders")},
    ),
)


def _dirty_audit_sql(rows: list[tuple[str, str]]) -> str:
    body = "\nUNION ALL ".join(f"SELECT '{label}' AS audit, ({n}) AS violations" for label, n in rows)
    return with_roles(f"SELECT audit, violations, CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM ({body})", DIRT)


register(
    "dq_dirty_fk_audit",
    lambda m: Q.foreign_key_audit(dirty_tables(m)),
    _dirty_audit_sql(
        [
            (f"{child}.{key}->{parent}", f"SELECT count(*) FROM d_{child} c WHERE NOT EXISTS (SELECT 1 FROM d_{parent} p WHERE p.{key} = c.{key})")
            for child, key, parent in Q.FOREIGN_KEYS
        ]
    ),
)
register(
    "dq_dirty_null_audit",
    lambda m: Q.null_audit(dirty_tables(m)),
    _dirty_audit_sql(
        [(f"{n}_null_keys", f"SELECT count(*) FROM d_{n} WHERE " + " OR ".join(f"{k} IS NULL" for k in RULES[n].key)) for n in PIPELINE_DATASETS]
    ),
)

# Tables that lack a required column, carry one that no rule knows, and have one of the wrong type.
_LACKS = {"customers": "customer_city", "orders": "order_status", "reviews": "review_score"}
_SURPLUS = {"products": "colour", "payments": "currency"}
_MISTYPED = {"translations": "product_category_name_english", "payments": "payment_type"}


def _misshapen(m) -> dict[str, DataFrame]:
    out = {}
    for n, t in raw_tables(m).items():
        t = t.drop(_LACKS[n]) if n in _LACKS else t
        t = t.withColumn(_SURPLUS[n], F.lit("x")) if n in _SURPLUS else t
        out[n] = t.withColumn(_MISTYPED[n], F.lit(1)) if n in _MISTYPED else t
    return out


def _shape(m):
    parts = [
        t.agg(
            F.lit(n).alias("dataset"),
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(Q.missing_columns(t, RULES[n]))).cast("long").alias("missing"),
            F.lit(len(Q.unexpected_columns(t, RULES[n]))).cast("long").alias("unexpected"),
            F.lit(len(Q.type_mismatches(t, RULES[n]))).cast("long").alias("mistyped"),
        )
        for n, t in _misshapen(m).items()
    ]
    return union_reports(parts)


register(
    "dq_dirty_schema",
    _shape,
    with_roles(
        "\nUNION ALL ".join(
            f"""SELECT '{n}' AS dataset, count(*) AS rows, {big(str(int(n in _LACKS)))} AS missing, {big(str(int(n in _SURPLUS)))} AS unexpected,
  {big(str(MISMATCHES[n] + (n in _MISTYPED)))} AS mistyped FROM {sql_name(n)}"""
            for n in PIPELINE_DATASETS
        )
    ),
)
