"""Sinks: CSV, Parquet, JSON reports, and verified table loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.model import CURATED, LOAD_LEVELS
from marketlens.sources.workspace import concurrently


class LoadError(RuntimeError):
    """A load wrote fewer rows than it was given."""


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def tidy(section: str, df: DataFrame) -> DataFrame:
    """A report table as (section, row, metric, value) rows; ``row`` holds its text columns."""
    texts = [c for c, t in df.dtypes if t == "string"]
    label = F.concat_ws("/", *texts) if texts else F.lit("")
    metrics = [c for c in df.columns if c not in texts]
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics])
    return df.select(F.lit(section).alias("section"), label.alias("row"), F.inline(pairs))


def json_report(sections: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [tidy(name, df) for name, df in sections.items()])


def write_json_report(sections: Mapping[str, DataFrame], path: str) -> None:
    json_report(sections).write.mode("overwrite").json(path)


def to_target(name: str, df: DataFrame) -> DataFrame:
    """Project to the target columns that exist, with the target types; unparseable values become null."""
    return df.select([F.col(c).try_cast(t).alias(c) for c, t in CURATED[name].items() if c in df.columns])


def load_table(name: str, df: DataFrame, base: str) -> DataFrame:
    """Write one curated table and count it back: (dataset, attempted, inserted, skipped, verified).

    Translations have no target table: they are counted as skipped. Attempted rows are
    observed during the write, so the input is computed once. The new table is written and counted
    beside the old one and takes its place only then: a failed load leaves the old table.
    """
    spark = df.sparkSession
    if name not in CURATED:
        n = df.count()
        return _load_row(spark, name, n, 0, n)
    attempted = Observation(f"attempted-{uuid.uuid4().hex}")
    path = f"{base}/_loading/{name}-{uuid.uuid4().hex}"
    to_target(name, df.observe(attempted, F.count(F.lit(1)).alias("n"))).write.parquet(path)
    inserted, attempted = spark.read.parquet(path).count(), attempted.get["n"]
    if inserted < attempted:
        raise LoadError(f"{name}: {inserted} of {attempted} rows found after the load")
    _switch(spark, path, f"{base}/{name}")
    return _load_row(spark, name, attempted, inserted, 0)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete table was written to ``path``."""
    at, fs = _hadoop(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def _switch(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished table in the place of the old one, which goes last."""
    source, fs = _hadoop(spark, new)
    target, _ = _hadoop(spark, path)
    old, _ = _hadoop(spark, f"{new}-replaced")
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise LoadError(f"{path}: the old table cannot be moved aside")
    if not fs.rename(source, target):
        raise LoadError(f"{path}: the new table cannot be put in place")
    if replaced:
        fs.delete(old, True)


def moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a place that does not exist yet; False, and nothing done, in another file system."""
    (source_at, fs), (target_at, other) = _hadoop(spark, source), _hadoop(spark, target)
    if not fs.getUri().equals(other.getUri()):
        return False
    fs.mkdirs(target_at.getParent())
    if not fs.rename(source_at, target_at):
        raise LoadError(f"{target}: {source} cannot be moved there")
    return True


def _load_row(spark: SparkSession, name: str, attempted: int, inserted: int, skipped: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("dataset"),
        F.lit(attempted).cast("long").alias("attempted"),
        F.lit(inserted).cast("long").alias("inserted"),
        F.lit(skipped).cast("long").alias("skipped"),
        F.lit(inserted + skipped >= attempted).alias("verified"),
    )


def load_batch(
    tables: Mapping[str, DataFrame], base: str, on_loaded: Callable[[str], None] | None = None
) -> DataFrame:
    """Load parents before children; tables of one level load side by side.

    What has no target table is counted last. ``on_loaded`` is called with each dataset's
    name once its level is loaded and verified, from the calling thread.
    """

    def load(name: str) -> DataFrame:
        return load_table(name, tables[name], base)

    rows: list[DataFrame] = []
    for level in [*LOAD_LEVELS, tuple(n for n in tables if n not in CURATED)]:
        jobs = {n: (lambda n=n: load(n)) for n in level if n in tables}
        rows += concurrently(jobs).values()
        for name in jobs if on_loaded else ():
            on_loaded(name)
    return reduce(DataFrame.unionByName, rows)


def load_jdbc(name: str, df: DataFrame, url: str, properties: Mapping[str, str], batch_size: int = 10_000) -> None:
    """Append to a database table in batches; connections are bounded by the partition count."""
    writer = to_target(name, df).write.mode("append").option("batchsize", batch_size)
    writer.jdbc(url, name, properties=dict(properties))
