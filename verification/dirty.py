"""Dirtied text versions of the given tables: every missing marker, padding, bad dates and numbers.

Each has a Spark form and a separately written SQL form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.clean import MISSING_MARKERS


def _choice(n: Column, values: list[Column]) -> Column:
    """values[n mod len]"""
    k = n % len(values)
    out = None
    for i, v in enumerate(values):
        out = F.when(k == i, v) if out is None else out.when(k == i, v)
    return out


def customers(spark: SparkSession, base: str) -> DataFrame:
    c = spark.read.parquet(f"{base}/customer.parquet")
    n = spark.read.parquet(f"{base}/nation.parquet")
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    city = _choice(
        k,
        [F.lit(m) for m in MISSING_MARKERS]
        + [F.lit(" null "), F.concat(F.lit("  "), F.lower(seg), F.lit("\t\n")), F.lit("são paulo"), F.lower(seg), F.lit("rio_do-sul d'oeste")],
    )
    state = _choice(k, [F.lower("n_name"), F.lit(None), F.concat(F.lit(" "), F.col("n_name")), F.lit("N/A"), F.lit("sp")])
    zips = _choice(k, [F.lit("1310"), F.lit("abc"), (k % 100000).cast("string"), F.lit("123456"), F.lit("77.0"), F.lit("")])
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.cast("string").alias("customer_id"),
        k.cast("string").alias("customer_unique_id"),
        zips.alias("customer_zip_code_prefix"),
        city.alias("customer_city"),
        state.alias("customer_state"),
    )


def orders(spark: SparkSession, base: str) -> DataFrame:
    o = spark.read.parquet(f"{base}/orders.parquet")
    k = F.col("o_orderkey")
    when = _choice(
        k,
        [
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
            F.lit("not a date"),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit("2017-02-30 10:00:00"),
            F.lit("nan"),
        ],
    )
    status = F.col("o_orderstatus")
    return o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(status == "F", "DELIVERED").when(status == "O", " shipped ").alias("order_status"),
        when.alias("order_purchase_timestamp"),
    )


_MARK = [f"'{m}'" for m in MISSING_MARKERS]


def _case(key: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {key} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


DIRTY = {
    "dirty_customers": f"""
  SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
    {_case("c_custkey", ["'1310'", "'abc'", "CAST(c_custkey % 100000 AS VARCHAR)", "'123456'", "'77.0'", "''"])} AS customer_zip_code_prefix,
    {_case("c_custkey", _MARK + ["' null '", "'  ' || lower(c_mktsegment) || chr(9) || chr(10)", "'são paulo'", "lower(c_mktsegment)", "'rio_do-sul d''oeste'"])} AS customer_city,
    {_case("c_custkey", ["lower(n_name)", "NULL", "' ' || n_name", "'N/A'", "'sp'"])} AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dirty_orders": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN ' shipped ' END AS order_status,
    {_case("o_orderkey", ["strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "'not a date'", "strftime(o_orderdate, '%Y-%m-%d')", "'2017-02-30 10:00:00'", "'nan'"])} AS order_purchase_timestamp
  FROM orders""",
}


def sql_missing(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({', '.join(_MARK)}) THEN {c} END"


def sql_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^[[:space:]]+', ''), '[[:space:]]+$', '')"


def sql_title(c: str) -> str:
    return f"""array_to_string(list_transform(range(1, length({c}) + 1), lambda i:
    CASE WHEN i = 1 OR NOT regexp_full_match({c}[i - 1], '\\p{{L}}') THEN upper({c}[i]) ELSE lower({c}[i]) END), '')"""


def _case(column: str, id_: str, modulus: int, *values: str) -> str:
    """``column``, but for the rows whose id leaves remainder 1, 2, .. the given values."""
    whens = " ".join(f"WHEN {id_} % {modulus} = {i} THEN {v}" for i, v in enumerate(values, 1))
    return f"CASE {whens} ELSE {column} END"


#: Per role, columns with planted violations: SQL that Spark and DuckDB read alike.
ROLE_DIRT = {
    "customers": {
        "customer_id": _case("customer_id", "customer_id", 83, "customer_id - 1", "NULL"),
        "customer_zip_code_prefix": _case("customer_zip_code_prefix", "customer_id", 79, "-1", "100000", "NULL"),
        "customer_state": _case("customer_state", "customer_id", 71, "'ZZ'", "NULL"),
    },
    "orders": {
        "order_id": _case("order_id", "order_id", 73, "order_id - 1", "NULL"),
        "customer_id": _case("customer_id", "order_id", 61, "-1", "NULL"),
        "order_status": _case("order_status", "order_id", 67, "'lost'", "NULL"),
    },
    "order_items": {
        "order_item_id": _case("order_item_id", "order_id", 59, "0", "NULL"),
        "price": _case("price", "order_id", 53, "-1", "NULL"),
        "freight_value": _case("freight_value", "order_id", 47, "-1", "NULL"),
    },
    "products": {
        "product_id": _case("product_id", "product_id", 43, "product_id - 1", "NULL"),
        "product_weight_g": _case("product_weight_g", "product_id", 41, "-1", "NULL"),
        "product_width_cm": _case("product_width_cm", "product_id", 37, "-1", "NULL"),
    },
    "payments": {
        "payment_type": _case("payment_type", "order_id", 31, "'cash'", "NULL"),
        "payment_installments": _case("payment_installments", "order_id", 29, "-1", "NULL"),
        "payment_value": _case("payment_value", "order_id", 23, "-1", "NULL"),
    },
    "reviews": {
        "review_score": _case("review_score", "order_id", 19, "0", "6", "NULL"),
        "review_creation_date": _case("CAST(review_creation_date AS STRING)", "order_id", 17, "'not a date'", "NULL"),
    },
    "translations": {
        "product_category_name": "CASE WHEN product_category_name LIKE 'S%' THEN NULL ELSE product_category_name END",
    },
}


def roles(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: t.withColumns({c: F.expr(e) for c, e in ROLE_DIRT[n].items()}) for n, t in tables.items()}


def role_sql(names: dict[str, str]) -> dict[str, str]:
    """CTEs ``d_<role>``; ``names`` maps each role to its clean SQL name."""
    return {
        f"d_{n}": f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in ROLE_DIRT[n].items())}) FROM {source}"
        for n, source in names.items()
    }
