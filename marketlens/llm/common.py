"""What the operators of this subpackage share: inputs, null-safe joins, text rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"  # the white space that separates words


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def documents(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fold of a document."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of key columns that carry the same names on both sides."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def only(docs: DataFrame, chosen: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key occurs in ``chosen`` (null matches null); columns of ``docs`` only."""
    ids = chosen.select(F.col(key).alias("_chosen"))
    return docs.join(ids, docs[key].eqNullSafe(ids["_chosen"]), "left_semi")


def text_mark(text: Column) -> Column:
    """64 bits of a text, to tell rows apart that share a doc_id; null has a mark too."""
    return F.xxhash64(text.cast("string"))


def _same_row(docs: DataFrame, rows: DataFrame) -> Column:
    """``rows`` (_id, _mark) name rows of ``docs`` by doc_id (null matches null) and text."""
    return docs["doc_id"].cast("long").eqNullSafe(rows["_id"]) & (text_mark(docs["text"]) == rows["_mark"])


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``dropped`` (doc_id, mark) does not name."""
    rows = dropped.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    return docs.join(rows, _same_row(docs, rows), "left_anti")


def only_one(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each that ``chosen`` (doc_id, mark, copies) names; of copies that agree in
    doc_id and text the least by all columns."""

    def named(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
        return docs.join(rows, _same_row(docs, rows), "left_semi")

    again = named(chosen.filter("copies > 1"))
    least = again.groupBy(again["doc_id"].alias("_id"), text_mark(again["text"]).alias("_mark")).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return named(chosen.filter("copies = 1")).unionByName(least.select("_row.*"))
