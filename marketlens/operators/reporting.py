"""Small pieces the report families share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAT_COLUMNS = ["mean", "std", "min", "q25", "median", "q75", "max"]


def rounded_stats(described: DataFrame, keys: Sequence[str] = (), keep: Sequence[str] = ("n", "null_count")) -> DataFrame:
    """Two decimals for the statistics of ``describe``, four for the skewness."""
    return described.select(
        *keys,
        *keep,
        *[F.round(c, 2).alias(c) for c in STAT_COLUMNS],
        F.round("skewness", 4).alias("skewness"),
    )


def top_rows(df: DataFrame, ranking: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in ``order`` with their rank, labelled with the ranking's name."""
    best = df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")  # n rows
    return best.select(F.lit(ranking).alias("ranking"), rank.alias("rank"), *df.columns)


def with_all_labels(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """One row per label; counts and sums of absent labels are 0."""
    order = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias(column))
    return F.broadcast(order).join(df, column, "left").fillna(0)


def by_sections(df: DataFrame, sections: dict[str, Column], aggregates: Sequence[Column]) -> DataFrame:
    """Group one (already reduced) frame by several keys at once: (section, key) -> aggregates.

    One pass over ``df`` instead of one per section; null keys are left out.
    """
    pairs = F.array(
        *[F.struct(F.lit(name).alias("section"), key.cast("string").alias("key")) for name, key in sections.items()]
    )
    keyed = df.withColumn("_s", F.explode(pairs)).select("*", "_s.section", "_s.key").drop("_s")
    return keyed.filter(F.col("key").isNotNull()).groupBy("section", "key").agg(*aggregates)
