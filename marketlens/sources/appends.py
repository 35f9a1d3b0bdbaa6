"""Curated tables that grow by batches: idempotent append, replacement by key, rollback of one batch.

A batch is a folder of its own with its rows and the keys of older rows that it replaces. It is staged and
verified beside the table and becomes visible by one rename, so a failed batch leaves nothing behind. A reader drops
the rows that a later batch replaces; taking a batch back brings them out again. No file is ever rewritten.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.model import CURATED, RULES
from marketlens.sources.writers import LoadError, _hadoop, to_target

_BATCH = re.compile(r"^(\d{8})-(.+)$")  # folder: number in the order of arrival, name


def batches(spark: SparkSession, name: str, base: str) -> dict[str, int]:
    """Name -> number of the batches that the table holds."""
    at, fs = _hadoop(spark, f"{base}/{name}")
    if not fs.exists(at):
        return {}
    found = (_BATCH.match(f.getPath().getName()) for f in fs.listStatus(at))
    return {m[2]: int(m[1]) for m in found if m}


def _folder(name: str, base: str, batch: str, number: int) -> str:
    return f"{base}/{name}/{number:08d}-{batch}"


def _schema(name: str, columns: Sequence[str] | None = None) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in CURATED[name].items() if columns is None or c in columns)


def _numbered(df: DataFrame, part: str) -> DataFrame:
    number: Column = F.regexp_extract(F.col("_metadata.file_path"), rf".*/(\d{{8}})-[^/]*/{part}/", 1)
    return df.select("*", number.cast("int").alias("_batch"))


def read_appended(spark: SparkSession, name: str, base: str) -> DataFrame:
    """The table as all its batches leave it. Rows with a null in their key are never replaced."""
    held, keys = batches(spark, name, base), list(RULES[name].key)
    if not held:
        return spark.createDataFrame([], _schema(name))
    folders = [_folder(name, base, b, i) for b, i in held.items()]
    rows = spark.read.schema(_schema(name)).parquet(*[f"{f}/rows" for f in folders])
    if len(held) == 1:
        return rows
    replaced = spark.read.schema(_schema(name, keys)).parquet(*[f"{f}/replaced" for f in folders])
    last = _numbered(replaced, "replaced").groupBy(*keys).agg(F.max("_batch").alias("_by"))
    last = last.select("_by", *[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    return _numbered(rows, "rows").join(last, same & (F.col("_batch") < F.col("_by")), "left_anti").drop("_batch")


def append_table(name: str, df: DataFrame, base: str, batch: str) -> DataFrame:
    """Add a batch: one row (dataset, batch, status, attempted, inserted, updated).

    A row whose key the table has takes the older row's place. A batch of a name that the table holds
    is not read (``REPEATED``). A key that occurs twice in a batch, or a lost row, raises ``LoadError``, and the table
    stays as it was. One writer at a time per table.
    """
    spark, keys = df.sparkSession, list(RULES[name].key)
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"{batch!r}: a batch name has letters, digits, '_', '.' and '-' only")
    held = batches(spark, name, base)
    if batch in held:
        return _report(spark, name, batch, "REPEATED", 0, 0, 0)
    staging = f"{base}/_loading/{name}-{uuid.uuid4().hex}"
    try:
        seen = Observation(f"attempted-{uuid.uuid4().hex}")
        to_target(name, df.observe(seen, F.count(F.lit(1)).alias("n"))).write.parquet(f"{staging}/rows")
        rows = spark.read.schema(_schema(name)).parquet(f"{staging}/rows")
        whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("_new"))
        total, twice = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(whole & (F.col("n") > 1))).first()  # one row
        attempted = seen.get["n"]
        if total < attempted:
            raise LoadError(f"{name}: {total} of {attempted} rows found after the load of {batch}")
        if twice:
            raise LoadError(f"{name}: {twice} keys occur more than once in {batch}")
        old = read_appended(spark, name, base).select(*keys)
        old.join(rows.select(*keys), keys, "left_semi").write.parquet(f"{staging}/replaced")
        updated = spark.read.schema(_schema(name, keys)).parquet(f"{staging}/replaced").count()
        _publish(spark, staging, _folder(name, base, batch, max(held.values(), default=0) + 1))
    finally:
        at, fs = _hadoop(spark, staging)
        fs.delete(at, True)
    return _report(spark, name, batch, "LOADED", attempted, attempted - updated, updated)


def rollback_batch(spark: SparkSession, name: str, base: str, batch: str) -> bool:
    """Take one batch back, the last or an earlier one; whether the table held it."""
    held = batches(spark, name, base)
    if batch not in held:
        return False
    at, fs = _hadoop(spark, _folder(name, base, batch, held[batch]))
    aside, _ = _hadoop(spark, f"{base}/_loading/{name}-{uuid.uuid4().hex}")
    fs.mkdirs(aside.getParent())
    if not fs.rename(at, aside):  # out of sight at once, whatever becomes of its files
        raise LoadError(f"{name}: {batch} cannot be taken back")
    fs.delete(aside, True)
    return True


def _publish(spark: SparkSession, staging: str, folder: str) -> None:
    source, fs = _hadoop(spark, staging)
    target, _ = _hadoop(spark, folder)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise LoadError(f"{folder}: the batch cannot be put in place")


def _report(spark: SparkSession, name: str, batch: str, status: str, attempted: int, inserted: int, updated: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("dataset"),
        F.lit(batch).alias("batch"),
        F.lit(status).alias("status"),
        F.lit(attempted).cast("long").alias("attempted"),
        F.lit(inserted).cast("long").alias("inserted"),
        F.lit(updated).cast("long").alias("updated"),
    )
