from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.model import CURATED, PIPELINE_DATASETS, RULES, STATES
from marketlens.operators.quality import FOREIGN_KEYS
from marketlens.plans import etl
from marketlens.plans.quarantine import orphan_label, quarantine_log, route_all
from verification import dirty
from verification.pipeline_queries import as_text, folder
from verification.quality_queries import CONDITIONS, DOMAIN, raw_tables, sql_name
from verification.registry import register
from verification.roles_sql import big, rnd, with_roles

# Customers with known states, so that only the planted violations fail; dates are left in order.
_PLANTED = {
    **dirty.ROLE_DIRT,
    "customers": {
        **dirty.ROLE_DIRT["customers"],
        "customer_state": "CASE WHEN customer_id % 71 = 1 THEN 'ZZ' WHEN customer_id % 71 = 2 THEN ' null ' WHEN customer_id % 71 = 3 THEN ' sp' "
        "ELSE 'SP' END",
    },
    "payments": {
        **dirty.ROLE_DIRT["payments"],
        "payment_value": "CASE WHEN order_id % 23 = 1 THEN '-1' WHEN order_id % 23 = 2 THEN '12,5' ELSE CAST(payment_value AS STRING) END",
    },
    "order_items": {
        **dirty.ROLE_DIRT["order_items"],
        "shipping_limit_date": "CASE WHEN order_id % 37 = 1 THEN 'n/a' WHEN order_id % 37 = 2 THEN '31/12/1996' ELSE CAST(shipping_limit_date AS STRING) END",
    },
}


def planted(m) -> dict[str, DataFrame]:
    tables = {n: t.withColumns({c: F.expr(e) for c, e in _PLANTED[n].items()}) for n, t in raw_tables(m).items()}
    return {n: as_text(t) for n, t in tables.items()}


MARKERS = "('', 'null', 'NULL', 'None', 'NONE', 'NaN', 'nan', 'N/A', 'n/a')"


def _cleaned(role: str) -> str:
    """Raw values as the checks see them, all text, with numbers and dates parsed beside."""
    rules = RULES[role]
    out = []
    for c in rules.types:
        text = f"CAST({_PLANTED[role][c]} AS VARCHAR)" if c in _PLANTED[role] else f"CAST({c} AS VARCHAR)"
        kept = f"CASE WHEN {text} NOT IN {MARKERS} THEN trim({text}, ' ' || chr(9) || chr(10) || chr(13)) END"
        if c in rules.bounds:
            out += [f"TRY_CAST({kept} AS DOUBLE) AS {c}", f"({kept}) IS NOT NULL AND TRY_CAST({kept} AS DOUBLE) IS NULL AS bad_{c}", f"({kept}) AS text_{c}"]
        elif c in rules.date_fields:
            out += [f"TRY_CAST({kept} AS TIMESTAMP) AS {c}", f"({kept}) IS NOT NULL AND TRY_CAST({kept} AS TIMESTAMP) IS NULL AS bad_{c}", f"({kept}) AS text_{c}"]
        else:
            out.append(f"({kept}) AS {c}")
    return f"SELECT {', '.join(out)} FROM {sql_name(role)}"


def _any(conditions) -> str:
    return " OR ".join(f"coalesce({c}, FALSE)" for c in conditions) or "FALSE"


def _checks(role: str) -> dict[str, str]:
    """Name of each check -> condition, in the order of the names that a row lists."""
    rules = RULES[role]
    text = lambda c: f"text_{c}" if c in rules.bounds or c in rules.date_fields else c
    out = {
        "nullable_fields": _any(f"{text(c)} IS NULL" for c in rules.required),
        "enum_fields": _any(CONDITIONS["enum_fields"][role].values()),
        "numeric_constraints": _any(c for c in CONDITIONS["numeric_constraints"][role].values() if c),
        "date_fields": _any(f"bad_{c}" for c in rules.date_fields),
    }
    out |= {check: _any(conds) for r, check, conds in DOMAIN.values() if r == role}
    out["malformed_numbers"] = _any(f"bad_{c}" for c in rules.bounds)
    out["null_key"] = _any(f"{text(k)} IS NULL" for k in rules.key)
    return out


def _routed_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {}
    for level in (("translations", "customers", "products"), ("orders",), ("order_items", "payments", "reviews")):
        for role in level:
            ctes[f"w_{role}"] = _cleaned(role)
            labels = [f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _checks(role).items()]
            labels += [
                f"CASE WHEN NOT EXISTS (SELECT 1 FROM q_{parent} p WHERE p.violations = '' AND p.{key} = w.{key}) THEN '{orphan_label(child, parent)}' END"
                for child, key, parent in FOREIGN_KEYS
                if child == role
            ]
            ctes[f"q_{role}"] = f"SELECT w.*, concat_ws(',', {', '.join(labels)}) AS violations FROM w_{role} w"
    return ctes


ROUTED = _routed_ctes()


def _rows(m):
    routed = route_all(planted(m), f"{folder(m.orders.sparkSession)}/quarantine", limit=1.0)
    out = None
    for name, r in routed.items():
        both = r.valid.select(F.lit("").alias("violations")).unionByName(r.rejected.select(F.concat_ws(",", "_violations").alias("violations")))
        part = both.groupBy(F.lit(name).alias("dataset"), "violations").agg(F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "etl_quarantine_rows",
    _rows,
    with_roles("\nUNION ALL ".join(f"SELECT '{n}' AS dataset, violations, count(*) AS rows FROM q_{n} GROUP BY violations" for n in PIPELINE_DATASETS), ROUTED),
)


def _log(m):
    spark = m.orders.sparkSession
    path = f"{folder(spark)}/quarantine"
    route_all(planted(m), path, limit=1.0)
    return quarantine_log(spark, path).select("dataset", "total_rows", "quarantined_rows", "error_rate")


register(
    "etl_quarantine_log",
    _log,
    with_roles(
        "\nUNION ALL ".join(
            f"""SELECT '{n}' AS dataset, count(*) AS total_rows, count(*) FILTER (violations <> '') AS quarantined_rows,
  {rnd("count(*) FILTER (violations <> '') / count(*)", 6)} AS error_rate FROM q_{n}"""
            for n in PIPELINE_DATASETS
        ),
        ROUTED,
    ),
)


def _run(m):
    base = folder(m.orders.sparkSession)
    metrics = etl.run_all(planted(m), f"{base}/curated", quarantine=f"{base}/quarantine", error_limit=1.0)
    return metrics.drop("validation", "loaded")


def _run_sql(n: str) -> str:
    keys = ", ".join(f"text_{k}" if k in RULES[n].bounds else k for k in RULES[n].key)
    tried = f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM q_{n} WHERE violations = ''))"
    inserted, skipped = (tried, "0") if n in CURATED else ("0", tried)
    return f"""SELECT '{n}' AS dataset, count(*) AS rows_extracted, count(*) FILTER (violations <> '') AS rows_quarantined,
  {big(tried)} AS attempted, {big(inserted)} AS inserted, {big(skipped)} AS skipped FROM q_{n}"""


register("etl_run_quarantined", _run, with_roles("\nUNION ALL ".join(_run_sql(n) for n in PIPELINE_DATASETS), ROUTED))
