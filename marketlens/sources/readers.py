"""Readers: raw CSV per dataset, curated Parquet, JDBC tables, the joined analysis view."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.model import MALFORMED, PIPELINE_DATASETS, RULES
from marketlens.sources.market import Market
from marketlens.sources.workspace import stored


# Datasets whose quoted values may hold line breaks. Only these give up file splitting.
MULTILINE = {"reviews"}


# Names Spark's reader does not know.
ENCODINGS = {"latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "utf8": "UTF-8"}


class ExtractionError(RuntimeError):
    """A raw file is absent, unreadable, or lacks required columns."""


# Dataset -> word that its raw file name contains, most specific first.
FILE_WORDS = {
    "order_items": "order_items",
    "payments": "payments",
    "reviews": "reviews",
    "translations": "translation",
    "geolocation": "geolocation",
    "customers": "customers",
    "products": "products",
    "sellers": "sellers",
    "orders": "orders",
}


def detect_dataset(path: str) -> str | None:
    """Dataset of a file path or dataset name; None if it is neither."""
    stem = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if stem in RULES:
        return stem
    return next((name for name, word in FILE_WORDS.items() if word in stem), None)


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _uri(name: Column | str) -> Column:
    """A file's address; a local one is written with one or three slashes."""
    return F.regexp_replace(name, "^file:/+", "file:/").alias("file")


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per file at ``path``: file, path, bytes, lines, encoding.

    A file is UTF-8 if all of its lines are: no byte of a longer character is a line break, so the lines
    of one file may be judged by many tasks. Whatever is not UTF-8 is taken for Latin-1. A file
    without a byte counts as UTF-8.
    """
    text = spark.read.text(path)
    # A scan passes files without a byte over; the driver's listing has them.
    listed = spark.createDataFrame([(f,) for f in text.inputFiles()], "file string").select(_uri("file"))
    sizes = spark.read.format("binaryFile").load(path)  # no content is read
    sizes = sizes.select(_uri("_metadata.file_path"), "path", F.col("length").alias("bytes"))
    listed = listed.join(sizes, "file", "left").fillna({"bytes": 0})
    lines = text.select(_uri("_metadata.file_path"), F.is_valid_utf8("value").alias("valid"))
    judged = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.bool_and("valid").alias("valid"))
    encoding = F.when(F.coalesce("valid", F.lit(True)), "UTF-8").otherwise("ISO-8859-1")
    return listed.join(judged, "file", "left").select(
        "file", "path", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), encoding.alias("encoding")
    )


def read_csv(
    spark: SparkSession, path: str, dataset: str | None = None, encoding: str | None = None, malformed: bool = False
) -> DataFrame:
    """Raw text columns of one dataset, in the order of the file's header.

    Everything stays text, so a bad value is counted later rather than failing the read. Without
    an ``encoding`` each file is read in the one that its bytes show. With ``malformed`` the column
    MALFORMED holds the text of rows that have too few or too many fields, else null.
    """
    name = _known(spark, path, dataset)
    if encoding is not None:
        groups = {ENCODINGS.get(encoding.lower(), encoding): [path]}
    else:
        groups = _by_encoding(file_report(spark, path), path)
    return _union(_csv(spark, paths, name, code, malformed) for code, paths in groups.items())


def _known(spark: SparkSession, path: str, dataset: str | None) -> str:
    """The dataset of a path that must exist."""
    name = dataset or detect_dataset(path)
    if name is None:
        raise ExtractionError(f"cannot tell the dataset of {path}")
    if not _path_exists(spark, path):
        raise ExtractionError(f"raw file not found: {path}")
    return name


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _by_encoding(files: DataFrame, path: str) -> dict[str, list[str]]:
    """Encoding -> paths to read in it; files without a byte are left out where there are others."""
    kept = files.filter("bytes > 0")
    codes = sorted(r["encoding"] for r in kept.select("encoding").distinct().collect())  # two at most
    if len(codes) < 2:
        return {(codes or ["UTF-8"])[0]: [path]}
    paths = kept.select("encoding", "path").collect()  # names of files, as the driver lists them anyway
    return {code: [r["path"] for r in paths if r["encoding"] == code] for code in codes}


def _csv(spark: SparkSession, paths: list[str], name: str, encoding: str, malformed: bool) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("multiLine", name in MULTILINE)
        .option("escape", '"')
        .option("inferSchema", False)
    )
    raw = reader.csv(paths)
    missing = [c for c in header_columns(name) if c not in raw.columns]
    if missing:
        raise ExtractionError(f"{', '.join(paths[:3])} lacks required columns: {missing}")
    if not malformed:
        return raw
    schema = raw.schema.add(MALFORMED, "string")
    # Fields are only counted where all of them are parsed.
    return reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(paths)


@dataclass(frozen=True)
class Load:
    """A staged dataset (with MALFORMED), and its load table: one row per file."""

    frame: DataFrame
    report: DataFrame


def load_csv(spark: SparkSession, path: str, dataset: str | None = None) -> Load:
    """Stage one dataset as Parquet and say what came of each file.

    The report has dataset, file, encoding, bytes, columns, rows, malformed_rows and status: ``EMPTY``
    for a file without rows, ``MALFORMED`` if any of its rows is, else ``OK``.
    """
    name = _known(spark, path, dataset)
    files = stored(file_report(spark, path), "files")
    parts = [_csv(spark, paths, name, code, True) for code, paths in _by_encoding(files, path).items()]
    staged = stored(_union(p.withColumn("_file", _uri("_metadata.file_path")) for p in parts), f"raw-{name}")
    found = staged.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed_rows")
    )
    zero = F.lit(0).cast("long")
    report = files.join(found, "file", "left").select(
        F.lit(name).alias("dataset"),
        "file",
        "encoding",
        "bytes",
        F.lit(len(staged.columns) - 2).cast("long").alias("columns"),
        F.coalesce("rows", zero).alias("rows"),
        F.coalesce("malformed_rows", zero).alias("malformed_rows"),
    )
    status = F.when(F.col("rows") == 0, "EMPTY").when(F.col("malformed_rows") > 0, "MALFORMED").otherwise("OK")
    return Load(staged.drop("_file"), report.withColumn("status", status))


def header_columns(dataset: str) -> list[str]:
    """Columns the raw file must carry: all known ones, optional values included."""
    return list(RULES[dataset].types)


def read_all_csv(
    spark: SparkSession, paths: Sequence[str], encoding: str | None = None, malformed: bool = False
) -> dict[str, DataFrame]:
    """Lazy frames by dataset; files of datasets outside the pipeline are read but not returned."""
    out: dict[str, DataFrame] = {}
    for path in paths:
        name = detect_dataset(path)
        if name in PIPELINE_DATASETS:
            out[name] = read_csv(spark, path, name, encoding, malformed)
    return out


def read_table(spark: SparkSession, name: str, base: str | None = None, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """One curated table from the single configured source: a Parquet base or a JDBC database."""
    if (base is None) == (jdbc is None):
        raise ValueError("give exactly one of base and jdbc")
    if base is not None:
        return spark.read.parquet(f"{base}/{name}")
    return spark.read.format("jdbc").options(**jdbc, dbtable=name).load()


def read_parquet_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame | None:
    """The requested columns that exist; None when the file is absent."""
    if not _path_exists(spark, path):
        return None
    df = spark.read.parquet(path)
    return df.select([c for c in columns if c in df.columns])


def full_view(market: Market) -> DataFrame:
    """Orders with customers, items, products, payments and reviews.

    A fan-out view: an order with i items and p payments yields i x p rows.
    """
    return (
        market.orders.join(market.customers, "customer_id")
        .join(market.order_items, "order_id", "left")
        .join(market.products, "product_id", "left")
        .join(market.payments, "order_id", "left")
        .join(market.reviews, "order_id", "left")
    )
