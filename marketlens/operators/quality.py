"""Data-quality checks compiled from the declarative rules.

All row predicates of a dataset become one aggregation over its rows. Key uniqueness and
foreign keys each need one shuffle of their own, on the key only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, ratio
from marketlens.model import MALFORMED, ORDER_STATUSES, PIPELINE_DATASETS, RULES, STATES, DatasetRules

INFO, WARNING, ERROR, CRITICAL = "INFO", "WARNING", "ERROR", "CRITICAL"
MAX_ERROR_RATE = 0.05

VALIDATE_ORDER = list(PIPELINE_DATASETS)
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("payments", "order_id", "orders"),
    ("reviews", "order_id", "orders"),
]


class CircuitBreaker(RuntimeError):
    """Raised when a dataset has a CRITICAL failure, or too many invalid rows."""


@dataclass(frozen=True)
class RowCheck:
    """``hits`` are the predicates counted; a row is invalid when any holds and ``marks`` is set."""

    name: str
    severity: str
    hits: tuple[Column, ...]
    marks: bool = True


def number(c: str) -> Column:
    """The column as a number, null if it does not parse."""
    return F.col(c).try_cast("double")


def instant(df: DataFrame, c: str) -> Column:
    return F.try_to_timestamp(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c)


def not_in(c: str, allowed: list[str]) -> Column:
    """True for null as well."""
    return ~F.coalesce(F.col(c).isin(allowed), F.lit(False))


def outside(c: str, rules: DatasetRules) -> Column:
    v, b = number(c), rules.bounds[c]
    bad = F.lit(False)
    if b.low is not None:
        bad = bad | (v < b.low)
    if b.high is not None:
        bad = bad | (v > b.high)
    if not b.allow_zero:
        bad = bad | (v == 0)
    return F.coalesce(bad, F.lit(False))


# ---- row checks ----------------------------------------------------------------------------


def null_hits(df: DataFrame, rules: DatasetRules) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in rules.required if c in df.columns}


def enum_hits(df: DataFrame, rules: DatasetRules) -> dict[str, Column]:
    return {
        c: F.col(c).isNotNull() & not_in(c, allowed) for c, allowed in rules.enums.items() if c in df.columns
    }


def numeric_hits(df: DataFrame, rules: DatasetRules) -> dict[str, Column]:
    return {c: outside(c, rules) for c in rules.bounds if c in df.columns}


def date_hits(df: DataFrame, rules: DatasetRules) -> dict[str, Column]:
    return {c: F.col(c).isNotNull() & instant(df, c).isNull() for c in rules.date_fields if c in df.columns}


def sequence_hits(df: DataFrame) -> tuple[Column, ...]:
    """Purchase <= approval <= carrier <= customer, as three separate comparisons."""
    cols = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    ]
    if not all(c in df.columns for c in cols):
        return ()
    stages = [instant(df, c) for c in cols]
    return tuple(F.coalesce(a > b, F.lit(False)) for a, b in zip(stages, stages[1:]))


def domain_checks(name: str, df: DataFrame) -> list[RowCheck]:
    has = set(df.columns).__contains__
    out: list[RowCheck] = []
    if name == "customers":
        if has("customer_state"):
            out.append(RowCheck("customers_state_code", ERROR, (not_in("customer_state", STATES),)))
        if has("customer_zip_code_prefix"):
            z = number("customer_zip_code_prefix")
            out.append(RowCheck("customers_zip_bounds", ERROR, (z.isNull() | (z < 0) | (z > 99999),)))
    elif name == "orders":
        if has("order_status"):
            out.append(RowCheck("orders_status", ERROR, (not_in("order_status", ORDER_STATUSES),)))
        steps = sequence_hits(df)
        if steps:
            out.append(RowCheck("orders_timestamp_sequence", WARNING, steps))
    elif name == "products":
        dims = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
        negative = [F.coalesce(number(c) < 0, F.lit(False)) for c in dims if has(c)]
        if negative:
            out.append(RowCheck("products_dimensions", ERROR, (reduce(Column.__or__, negative),)))
    elif name == "payments":
        for c, check in (("payment_value", "payments_value"), ("payment_installments", "payments_installments")):
            if has(c):
                v = number(c)
                out.append(RowCheck(check, ERROR, (v.isNull() | (v < 0),)))
    elif name == "reviews" and has("review_score"):
        v = number("review_score")
        out.append(RowCheck("reviews_score_range", ERROR, (v.isNull() | (v < 1) | (v > 5),)))
    return out


def row_checks(name: str, df: DataFrame) -> list[RowCheck]:
    rules = RULES[name]
    return [
        RowCheck("nullable_fields", ERROR, tuple(null_hits(df, rules).values())),
        RowCheck("enum_fields", ERROR, tuple(enum_hits(df, rules).values())),
        RowCheck("numeric_constraints", ERROR, tuple(numeric_hits(df, rules).values())),
        RowCheck("date_fields", ERROR, tuple(date_hits(df, rules).values())),
        *domain_checks(name, df),
    ]


def column_violations(name: str, df: DataFrame) -> DataFrame:
    """Violation count per generic check and column, zeros included."""
    rules = RULES[name]
    kinds = {
        "nullable_fields": null_hits(df, rules),
        "enum_fields": enum_hits(df, rules),
        "numeric_constraints": numeric_hits(df, rules),
        "date_fields": date_hits(df, rules),
    }
    named = [(k, c, hit) for k, hits in kinds.items() for c, hit in hits.items()]
    one = df.agg(*[count_if(hit).alias(f"v{i}") for i, (_, _, hit) in enumerate(named)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("dataset"), F.lit(k).alias("check"), F.lit(c).alias("column"), F.col(f"v{i}").alias("violations"))
            for i, (k, c, _) in enumerate(named)
        ]
    )
    return one.select(F.inline(rows))


# ---- keys ----------------------------------------------------------------------------------


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows sharing a key (all copies; nulls compare equal), surplus rows, null keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_rows"),
        count_if(F.col("n") > 1).alias("duplicate_keys"),
        total(F.col("n") - 1).alias("surplus_rows"),
        total(F.when(any_null, F.col("n"))).alias("null_key_rows"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1").drop("_copies")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is null or absent from the parent."""
    keys = parent.select(F.col(parent_key or key).alias(key)).filter(F.col(key).isNotNull())
    return child.join(keys, key, "left_anti")


def orphan_count(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Orphan rows, counted per distinct key first so a hot key is one row in the join."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_key, key, parent).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def unknown_categories(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Products whose non-null category has no translation."""
    return orphans(
        products.filter(F.col("product_category_name").isNotNull()), "product_category_name", translations
    )


# ---- schema checks (no job) ----------------------------------------------------------------

# Raw text is untyped and stands for any kind; what does not parse is counted by other checks.
_FAMILIES = {
    "text": ("string",),
    "whole": ("string", "tinyint", "smallint", "int", "bigint"),
    "number": ("string", "float", "double", "decimal"),
}


def missing_columns(df: DataFrame, rules: DatasetRules) -> list[str]:
    return [c for c in rules.required if c not in df.columns]


def unexpected_columns(df: DataFrame, rules: DatasetRules) -> list[str]:
    return [c for c in df.columns if c not in rules.types and c != MALFORMED]


def type_mismatches(df: DataFrame, rules: DatasetRules) -> list[str]:
    actual = dict(df.dtypes)
    return [c for c, kind in rules.types.items() if c in actual and not actual[c].startswith(_FAMILIES[kind])]


# ---- reports -------------------------------------------------------------------------------


def _report_rows(name: str, checks: list[tuple[str, str, Column]]) -> Column:
    """(check, severity on failure, violations) -> array of report rows."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(i + 1).cast("long").alias("check_order"),
                F.lit(check).alias("check"),
                F.when(v == 0, "PASSED").when(F.lit(sev).isin(INFO, WARNING), "WARNING").otherwise("FAILED").alias("status"),
                F.when(v == 0, F.lit(INFO)).otherwise(F.lit(sev)).alias("severity"),
                v.cast("long").alias("violations"),
            )
            for i, (check, sev, v) in enumerate(checks)
        ]
    )


def quality_report(name: str, df: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per check: status, severity and violation count.

    A primary key with nulls is CRITICAL and is reported apart from its duplicates.
    """
    rules, parents = RULES[name], parents or {}
    checks: list[tuple[str, str, Column]] = [
        ("required_columns", CRITICAL, F.lit(len(missing_columns(df, rules)))),
        ("unexpected_columns", WARNING, F.lit(len(unexpected_columns(df, rules)))),
        ("column_types", INFO, F.lit(len(type_mismatches(df, rules)))),
    ]
    rows = row_checks(name, df)
    hits = {f"r{i}_{j}": count_if(h) for i, c in enumerate(rows) for j, h in enumerate(c.hits)}
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[h.alias(k) for k, h in hits.items()])
    # Every join below is between one-row frames.
    keys = [k for k in rules.key if k in df.columns]
    if keys and len(keys) == len(rules.key):
        one = one.crossJoin(F.broadcast(key_violations(df, keys)))
        if rules.primary_key:
            checks.append(("primary_key_nulls", CRITICAL, F.col("null_key_rows")))
            checks.append(("primary_key_uniqueness", ERROR, F.col("duplicate_rows")))
        else:
            checks.append(("composite_key_uniqueness", ERROR, F.col("duplicate_rows")))
    for i, c in enumerate(rows):
        counted = reduce(Column.__add__, [F.col(f"r{i}_{j}") for j in range(len(c.hits))], F.lit(0))
        checks.append((c.name, c.severity, counted))
    if name == "orders" and "customers" in parents and "customer_id" in df.columns:
        fk = orphan_count(df, "customer_id", parents["customers"]).withColumnRenamed("violations", "_fk")
        one = one.crossJoin(F.broadcast(fk))
        checks.append(("orders_customer_foreign_key", ERROR, F.col("_fk")))
    if name == "products" and "translations" in parents and "product_category_name" in df.columns:
        per_cat = df.filter(F.col("product_category_name").isNotNull())
        fk = orphan_count(per_cat, "product_category_name", parents["translations"])
        one = one.crossJoin(F.broadcast(fk.withColumnRenamed("violations", "_fk")))
        checks.append(("products_translation_existence", WARNING, F.col("_fk")))
    return one.select(F.inline(_report_rows(name, checks)))


def quality_summary(report: DataFrame) -> DataFrame:
    """One row per dataset: overall status and check counts."""
    failed, warned = F.col("status") == "FAILED", F.col("status") == "WARNING"
    critical = failed & (F.col("severity") == CRITICAL)
    return report.groupBy("dataset").agg(
        F.when(count_if(failed) > 0, "FAILED").when(count_if(warned) > 0, "WARNING").otherwise("PASSED").alias("status"),
        F.count(F.lit(1)).alias("total_checks"),
        count_if(F.col("status") == "PASSED").alias("passed_count"),
        count_if(failed).alias("failed_count"),
        count_if(warned).alias("warning_count"),
        count_if(critical).alias("critical_count"),
    )


def quality_batch(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Reports of all given datasets, in dependency order."""
    parts = [quality_report(n, tables[n], tables) for n in VALIDATE_ORDER if n in tables]
    return reduce(DataFrame.unionByName, parts)


def overall_status(summary: DataFrame) -> DataFrame:
    worst = F.max(F.when(F.col("status") == "FAILED", 2).when(F.col("status") == "WARNING", 1).otherwise(0))
    return summary.agg(
        F.when(worst == 2, "FAILED").when(worst == 1, "WARNING").otherwise("PASSED").alias("overall_status"),
        F.count(F.lit(1)).alias("total_datasets"),
        count_if(F.col("status") != "FAILED").alias("passed_datasets"),
        count_if(F.col("status") == "FAILED").alias("failed_datasets"),
        (F.sum("critical_count") == 0).alias("can_continue"),
    )


def require_no_critical(summary: DataFrame) -> None:
    """Stop the pipeline on a CRITICAL failure. Collects one row per dataset."""
    bad = [r["dataset"] for r in summary.filter("critical_count > 0").orderBy("dataset").collect()]
    if bad:
        raise CircuitBreaker(f"CRITICAL validation failures on: {', '.join(bad)}")


# ---- rows ----------------------------------------------------------------------------------


def with_violations(
    name: str, df: DataFrame, parents: Mapping[str, DataFrame] | None = None, unique_keys: bool = True
) -> DataFrame:
    """Every row with ``_violations``, the names of the row-level checks it fails.

    With ``unique_keys`` all rows of a repeated key fail.
    """
    rules, parents = RULES[name], parents or {}
    found = [
        F.when(reduce(Column.__or__, c.hits), F.lit(c.name)) for c in row_checks(name, df) if c.marks and c.hits
    ]
    out = df
    keys = [k for k in rules.key if k in df.columns]
    if unique_keys and keys and len(keys) == len(rules.key):
        # Repeated keys are joined back, not counted in a window: a key shared by a third of
        # all rows is one row on the small side.
        again = repeated_keys(df, keys).select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_again"))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        out = out.join(again, same, "left").drop(*[f"_k_{k}" for k in keys])
        label = "primary_key_uniqueness" if rules.primary_key else "composite_key_uniqueness"
        repeated = F.coalesce("_again", F.lit(False))
        if rules.primary_key:
            repeated = repeated | F.col(keys[0]).isNull()
        found.append(F.when(repeated, F.lit(label)))
    if name == "orders" and "customers" in parents:
        known = parents["customers"].select(F.col("customer_id").alias("_parent")).filter("_parent IS NOT NULL").distinct()
        out = out.join(known, F.col("customer_id") == F.col("_parent"), "left")
        found.append(F.when(F.col("_parent").isNull(), F.lit("orders_customer_foreign_key")))
    named = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return out.withColumn("_violations", named).select(*df.columns, "_violations")


def invalid_row_counts(name: str, df: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    flagged = with_violations(name, df, parents)
    return flagged.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("total_rows"),
        count_if(F.size("_violations") > 0).alias("invalid_rows"),
    ).withColumn("error_rate", F.round(ratio(F.col("invalid_rows"), F.col("total_rows")), 6))


def split_quarantine(
    name: str, df: DataFrame, parents: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their ``_violations``)."""
    flagged = with_violations(name, df, parents)
    bad = F.size("_violations") > 0
    return flagged.filter(~bad).drop("_violations"), flagged.filter(bad)


def require_error_rate(counts: DataFrame, limit: float = MAX_ERROR_RATE) -> None:
    """Stop when a dataset's share of invalid rows passes the limit. Collects one row per dataset."""
    bad = [f"{r['dataset']} ({r['error_rate']:.2%})" for r in counts.filter(F.col("error_rate") > limit).collect()]
    if bad:
        raise CircuitBreaker(f"error rate above {limit:.0%}: {', '.join(bad)}")


# ---- audits of loaded tables ---------------------------------------------------------------


def foreign_key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for child, key, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            n = orphan_count(tables[child], key, tables[parent])
            parts.append(n.select(F.lit(f"{child}.{key}->{parent}").alias("audit"), F.col("violations").cast("long")))
    return _with_status(reduce(DataFrame.unionByName, parts))


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        keys = RULES[name].key
        if keys:
            bad = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
            parts.append(df.agg(F.lit(f"{name}_null_keys").alias("audit"), count_if(bad).alias("violations")))
    return _with_status(reduce(DataFrame.unionByName, parts))


def key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        keys = list(RULES[name].key)
        if keys:
            one = key_violations(df, keys)
            parts.append(one.select(F.lit(f"{name}_duplicate_keys").alias("audit"), F.col("duplicate_keys").alias("violations")))
    return _with_status(reduce(DataFrame.unionByName, parts))


def _with_status(audit: DataFrame) -> DataFrame:
    return audit.withColumn("status", F.when(F.col("violations") == 0, "PASSED").otherwise("FAILED"))
