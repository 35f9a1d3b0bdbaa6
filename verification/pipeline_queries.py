from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.model import CURATED, PIPELINE_DATASETS, RULES
from marketlens.operators import clean, kpi
from marketlens.plans import etl
from marketlens.plans.manifest import Manifest
from marketlens.sources import appends, readers, writers
from marketlens.sources.workspace import shared_dir, stored
from verification.eda_delivery_review_queries import STATES
from verification.quality_queries import raw_tables, sql_name
from verification.registry import QUERIES, ORACLES, register
from verification.roles_sql import big, count_if, dbl, mmean, msum, pct, rnd, with_roles


def folder(spark) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def text_tables(m) -> dict[str, DataFrame]:
    return {n: as_text(df) for n, df in raw_tables(m).items()}


# ---- sources and sinks: written, read back, and compared with the given tables


def _csv_round_trip(m):
    spark = m.customers.sparkSession
    path = f"{folder(spark)}/marketplace_customers_dataset.csv"
    writers.write_csv(as_text(m.customers), path)
    return readers.read_csv(spark, path)


CUSTOMERS_TEXT = (
    "SELECT "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in RULES["customers"].types)
    + " FROM customers"
)
register("src_csv", _csv_round_trip, with_roles(CUSTOMERS_TEXT))
register("sink_csv", _csv_round_trip, with_roles(CUSTOMERS_TEXT))


def _detect(m):
    spark = m.reviews.sparkSession
    path = f"{folder(spark)}/marketplace_order_reviews_dataset.csv"
    writers.write_csv(as_text(m.reviews), path)
    name = readers.detect_dataset(path)
    df = readers.read_csv(spark, path)
    return df.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length("review_comment_message")).alias("message_chars"),
    )


register(
    "src_detect",
    _detect,
    with_roles(f"SELECT 'reviews' AS dataset, count(*) AS rows, {big('sum(length(review_comment_message))')} AS message_chars FROM reviews"),
)


def _read_all(m):
    spark = m.orders.sparkSession
    base = folder(spark)
    paths = []
    for name, df in {**text_tables(m), "sellers": as_text(m.sellers)}.items():
        paths.append(f"{base}/marketplace_{name}_dataset.csv")
        writers.write_csv(df, paths[-1])
    frames = readers.read_all_csv(spark, paths)
    counts = [df.agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("rows")) for n, df in frames.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


COUNTS = "\nUNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS rows FROM {sql_name(n)}" for n in PIPELINE_DATASETS)
register("src_all", _read_all, with_roles(COUNTS))


# ---- raw files in two encodings, with malformed rows, a file without rows and one without a byte

_FIELDS = list(RULES["customers"].types)


def _raw_lines(m) -> DataFrame:
    """Customers as lines of text, half of them in each encoding; some have a field too many or too few."""
    city = F.concat(F.lit("São João "), "customer_city")
    fields = F.concat_ws(",", "customer_id", "customer_unique_id", "customer_zip_code_prefix", city, "customer_state")
    short = F.concat_ws(",", "customer_id", "customer_unique_id")
    k = F.col("customer_id")
    line = F.when(k % 50 == 1, F.concat(fields, F.lit(",surplus"))).when(k % 50 == 2, short).otherwise(fields)
    return m.customers.select(F.when(k % 2 == 0, F.encode(line, "ISO-8859-1").cast("string")).otherwise(line).alias("line"), (k % 2).alias("half"))


def _raw_files(m) -> str:
    spark, lines = m.customers.sparkSession, _raw_lines(m)
    path = f"{folder(spark)}/marketplace_customers_dataset.csv"
    header = spark.range(1).select(F.lit(",".join(_FIELDS)).alias("line"))
    for part in (lines.filter("half = 0"), lines.filter("half = 1"), lines.limit(0)):
        header.union(part.select("line")).coalesce(1).write.mode("append").text(path)  # each with its header
    spark.range(1).select(F.lit("")).limit(0).coalesce(1).write.mode("append").text(path)
    return path


def _load(m):
    report = readers.load_csv(m.customers.sparkSession, _raw_files(m)).report
    return report.groupBy("dataset", "encoding", "status", "columns").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("malformed_rows").alias("malformed_rows")
    )


register(
    "src_csv_load",
    _load,
    with_roles(
        f"""SELECT 'customers' AS dataset, CASE WHEN customer_id % 2 = 0 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, 'MALFORMED' AS status,
  {big("5")} AS columns, {big("1")} AS files, count(*) AS rows, count(*) FILTER (customer_id % 50 IN (1, 2)) AS malformed_rows FROM customers GROUP BY customer_id % 2
UNION ALL SELECT 'customers', 'UTF-8', 'EMPTY', {big("5")}, {big("2")}, {big("0")}, {big("0")}"""
    ),
)
register(
    "src_csv_encodings",
    lambda m: readers.read_csv(m.customers.sparkSession, _raw_files(m), malformed=True)
    .filter(F.col(readers.MALFORMED).isNull())
    .select(*_FIELDS),
    with_roles(
        """SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(customer_unique_id AS VARCHAR) AS customer_unique_id,
  CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix, 'São João ' || customer_city AS customer_city, customer_state
FROM customers WHERE customer_id % 50 NOT IN (1, 2)"""
    ),
)


def _table(m):
    spark = m.products.sparkSession
    base = folder(spark)
    ready = clean.transform_batch({n: text_tables(m)[n] for n in ("translations", "products")})
    writers.load_table("products", ready["products"], base)
    return readers.read_table(spark, "products", base).select("product_id", "category_name_english", "product_volume_cm3")


register(
    "src_table",
    _table,
    with_roles(
        f"""SELECT CAST(product_id AS VARCHAR) AS product_id, {rnd("product_volume_cm3")} AS product_volume_cm3,
  upper(s[1]) || lower(s[2:]) AS category_name_english
FROM (SELECT *, coalesce(category_name_english, 'Uncategorized') AS s FROM c_products)"""
    ),
)
QUERIES["src_parquet_projected"] = lambda spark, base: readers.read_parquet_columns(
    spark, f"{base}/lineitem.parquet", ["l_returnflag", "l_quantity", "no_such_column"]
).groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"))
ORACLES["src_parquet_projected"] = "SELECT l_returnflag, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1"
register(
    "src_full_join",
    lambda m: readers.full_view(m).groupBy("order_id", "customer_state").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price").cast("double").alias("price"), F.sum("payment_value").cast("double").alias("paid")
    ),
    with_roles(
        f"""SELECT o.order_id, c.customer_state, count(*) AS rows, {dbl("sum(i.price)")} AS price, {dbl("sum(y.payment_value)")} AS paid
FROM m_orders o JOIN customers c USING (customer_id) LEFT JOIN order_items i ON o.order_id = i.order_id
LEFT JOIN products p ON i.product_id = p.product_id LEFT JOIN payments y ON o.order_id = y.order_id
LEFT JOIN reviews r ON o.order_id = r.order_id GROUP BY 1, 2"""
    ),
)


def _parquet(m):
    spark = m.sellers.sparkSession
    path = f"{folder(spark)}/sellers.parquet"
    writers.write_parquet(m.sellers, path)
    return spark.read.parquet(path)


register("sink_parquet", _parquet, with_roles("SELECT * FROM sellers"))


def _json(m):
    spark = m.payments.sparkSession
    path = f"{folder(spark)}/report"
    counts = m.payments.groupBy("payment_type").agg(F.count(F.lit(1)).alias("transactions"))
    writers.write_json_report({"methods": counts}, path)
    return spark.read.schema("section string, row string, metric string, value string").json(path)


register(
    "sink_json_report",
    _json,
    with_roles(
        """SELECT 'methods' AS section, payment_type AS row, 'transactions' AS metric, CAST(count(*) AS VARCHAR) AS value
FROM payments GROUP BY payment_type"""
    ),
)


def _loaded(names):
    def query(m):
        base = folder(m.orders.sparkSession)
        ready = clean.transform_batch(etl.staged(text_tables(m)), keep=stored)
        return writers.load_batch({n: ready[n] for n in names}, base)

    return query


def _load_sql(names) -> str:
    def row(n: str) -> str:
        keys = ", ".join(RULES[n].key)
        inserted, skipped = ("n", "0") if n in CURATED else ("0", "n")
        return f"""SELECT '{n}' AS dataset, n AS attempted, {big(inserted)} AS inserted, {big(skipped)} AS skipped, TRUE AS verified
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT {keys} FROM {sql_name(n)}))"""

    return with_roles("\nUNION ALL ".join(row(n) for n in names))


register("sink_table_verified", _loaded(["order_items"]), _load_sql(["order_items"]))
register("sink_batch_ordered", _loaded(PIPELINE_DATASETS), _load_sql(PIPELINE_DATASETS))

# ---- batches: a second one replaces, comes again and adds nothing, a third is taken back


def _batches(m):
    spark = m.customers.sparkSession
    base, k = folder(spark), F.col("customer_id")
    city = lambda name: m.customers.withColumn("customer_city", F.lit(name))
    parts = [("first", m.customers.filter(k % 3 != 0)), ("second", city("moved").filter(k % 3 != 1)), ("second", city("twice")), ("third", city("wrong"))]
    loads = [appends.append_table("customers", df, base, batch) for batch, df in parts]
    appends.rollback_batch(spark, "customers", base, "third")
    return base, reduce(DataFrame.unionByName, loads)


register(
    "sink_append",
    lambda m: appends.read_appended(m.customers.sparkSession, "customers", _batches(m)[0]),
    with_roles(
        """SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(customer_unique_id AS VARCHAR) AS customer_unique_id,
  CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix,
  CASE WHEN customer_id % 3 = 1 THEN customer_city ELSE 'moved' END AS customer_city, customer_state FROM customers"""
    ),
)
register(
    "sink_append_report",
    lambda m: _batches(m)[1],
    with_roles(
        f"""SELECT 'customers' AS dataset, 'first' AS batch, 'LOADED' AS status, b + c AS attempted, b + c AS inserted, {big("0")} AS updated FROM n
UNION ALL SELECT 'customers', 'second', 'LOADED', a + c, a, c FROM n UNION ALL SELECT 'customers', 'second', 'REPEATED', {big("0")}, {big("0")}, {big("0")} FROM n
UNION ALL SELECT 'customers', 'third', 'LOADED', a + b + c, {big("0")}, a + b + c FROM n""",
        {
            "n": """SELECT count(*) FILTER (customer_id % 3 = 0) AS a, count(*) FILTER (customer_id % 3 = 1) AS b,
  count(*) FILTER (customer_id % 3 = 2) AS c FROM customers"""
        },
    ),
)

# ---- pipeline

def _run_all(m):
    spark = m.orders.sparkSession
    base = folder(spark)
    return etl.run_all(text_tables(m), f"{base}/curated", Manifest(spark, f"{base}/manifest")).drop("validation", "loaded")


def _etl_sql(skip: tuple[str, ...] = ()) -> str:
    def row(n: str) -> str:
        keys = ", ".join(RULES[n].key)
        tried = "0" if n in skip else f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {sql_name(n)}))"
        inserted, skipped = (tried, "0") if n in CURATED else ("0", tried)
        return f"""SELECT '{n}' AS dataset, count(*) AS rows_extracted, {big(tried)} AS attempted, {big(inserted)} AS inserted,
  {big(skipped)} AS skipped FROM {sql_name(n)}"""

    return with_roles("\nUNION ALL ".join(row(n) for n in PIPELINE_DATASETS))


register("etl_run_all", _run_all, _etl_sql())


def _resume(m):
    spark = m.orders.sparkSession
    base = folder(spark)
    manifest, target = Manifest(spark, f"{base}/manifest"), f"{base}/curated"
    # An earlier run that loaded two datasets and then stopped.
    ready = clean.transform_batch(text_tables(m))
    first = {n: ready[n] for n in ("customers", "products")}
    writers.load_batch(first, target, on_loaded=lambda n: manifest.record(n, "LOAD", "SUCCESS", target))
    return etl.run_all(text_tables(m), target, manifest, resume=True).drop("validation", "loaded")


register("etl_resume", _resume, _etl_sql(("customers", "products")))


def _run_dataset(m):
    base = folder(m.orders.sparkSession)
    t = text_tables(m)
    return etl.run_dataset("payments", t["payments"], base, t).drop("loaded")


register(
    "etl_run_dataset",
    _run_dataset,
    with_roles(
        f"""SELECT 'payments' AS dataset, count(*) AS rows_extracted, CASE WHEN count(*) > max(n) THEN 'FAILED' ELSE 'PASSED' END AS validation,
  max(n) AS attempted, max(n) AS inserted, CAST(0 AS BIGINT) AS skipped
FROM payments CROSS JOIN (SELECT count(*) AS n FROM (SELECT DISTINCT order_id, payment_sequential FROM payments))"""
    ),
)

# ---- KPIs

V = "order_delivered_customer_date"
register(
    "kpi_executive",
    lambda m: kpi.executive(m.curated().orders, m.customers, m.reviews),
    with_roles(
        f"""SELECT count(*) AS total_orders, (SELECT count(*) FROM customers) AS total_customers, {rnd(dbl("sum(order_value)") + " / count(*)")} AS average_order_value,
  {msum("order_value")} AS total_revenue, (SELECT {rnd(dbl("sum(review_score)") + " / count(*)")} FROM reviews) AS average_review_score,
  {pct(count_if("delivery_delay_days <= 0"), f"count({V})")} AS sla_percent FROM c_orders"""
    ),
)
register(
    "kpi_monthly_cumulative",
    lambda m: kpi.monthly_cumulative(m.curated().orders),
    with_roles(
        f"""SELECT year_month, {rnd("rev")} AS net_revenue, {rnd("sum(rev) OVER (ORDER BY year_month)")} AS cumulative_revenue
FROM (SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, sum(order_value) AS rev FROM c_orders GROUP BY 1)"""
    ),
)
register(
    "kpi_delivery",
    lambda m: kpi.delivery(m.curated().orders, m.reviews),
    with_roles(
        f"""SELECT {rnd(mmean("CAST(delivery_days AS DECIMAL(18,2))"))} AS average_delivery_days,
  {pct(count_if("delivery_delay_days > 0"), "count(*)")} AS late_delivery_rate_pct,
  {rnd("avg(review_score) FILTER (delivery_delay_days <= 0)")} AS on_time_avg_score,
  {rnd("avg(review_score) FILTER (delivery_delay_days > 0)")} AS late_avg_score
FROM c_orders JOIN reviews USING (order_id) WHERE {V} IS NOT NULL"""
    ),
)
register(
    "kpi_delivery_states",
    lambda m: kpi.delivery_states(m.curated().orders, m.customers),
    with_roles(
        """SELECT * FROM (
SELECT 'fastest' AS ranking, row_number() OVER (ORDER BY average_delivery_days, customer_state) AS rank, * FROM states
UNION ALL SELECT 'slowest', row_number() OVER (ORDER BY average_delivery_days DESC, customer_state), * FROM states) WHERE rank <= 10""",
        STATES,
    ),
)
