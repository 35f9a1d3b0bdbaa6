"""Joins of facts to a side with one row per key, where some keys hold a large share of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.sources.workspace import stored

#: A key is heavy if it holds more than this share of all rows: there are fewer than 1 / SHARE such keys.
SHARE = 0.001

#: Keys are counted in this many buckets. A bucket is crowded if it holds that many rows, and several times the mean.
BUCKETS = 4096
CROWDED_ROWS = 200_000

#: Facts that one task of a join sorts and reduces.
ROWS_PER_TASK = 2_000_000


def crowded_buckets(rows: DataFrame, keys: Sequence[str]) -> tuple[Column, list[int]]:
    """The bucket of a row by its keys, and the buckets that a repeated key fills; null is a key like others.

    One pass over the keys, which sends at most ``BUCKETS`` counts per task.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most BUCKETS rows
    limit = max(CROWDED_ROWS, 4 * sum(r["n"] for r in counts) // BUCKETS)
    return bucket, sorted(r["bucket"] for r in counts if r["n"] > limit)


def heavy_keys(facts: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """The non-null keys that hold more than ``share`` of the rows, written once; fewer than 1 / share rows."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    whole = facts.agg(F.count(F.lit(1)).alias("_whole"))  # one row
    heavy = counts.crossJoin(F.broadcast(whole)).filter(F.col("_n") > F.col("_whole") * share)
    return stored(heavy.select(key), "heavy-keys")


def join_by_frequency(facts: DataFrame, side: DataFrame, key: str, how: str = "inner", share: float = SHARE) -> DataFrame:
    """``facts`` joined to ``side``, which has at most one row per key, without gathering a heavy key.

    The keys are counted first. Rows of heavy keys meet their few rows of ``side`` by broadcast, whose
    size is bounded by 1 / share; only the other rows are shuffled, and no key among them is large.
    Rows without a key, however many, are not shuffled either. Give ``facts`` narrow: they are scanned
    once to count and once per part.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join: {how}")
    heavy = heavy_keys(facts, key, share)
    columns = [c for c in side.columns if c != key]
    light = facts.filter(F.col(key).isNotNull())
    parts = []
    if not heavy.isEmpty():
        few = stored(heavy.join(side, key, how), "heavy-side")
        parts.append(facts.join(F.broadcast(few), key))
        light = light.join(F.broadcast(heavy), key, "left_anti")
    parts.append(light.join(side, key, how))
    if how == "left":
        kinds = dict(side.dtypes)
        parts.append(facts.filter(F.col(key).isNull()).withColumns({c: F.lit(None).cast(kinds[c]) for c in columns}))
    return reduce(DataFrame.unionByName, parts)


def dealt_by(facts: DataFrame, side: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both by key over so many tasks that each joins some ``ROWS_PER_TASK`` facts, whatever their number.

    The session's number of shuffle partitions does not grow with the facts, so its tasks would. Facts that are
    few for it, or for the cores, are left to the planner. Counting the rows of Parquet files reads their footers.
    """
    spark = facts.sparkSession
    tasks = -(-facts.count() // ROWS_PER_TASK)
    if tasks <= min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism):
        return facts, side
    return facts.repartition(tasks, key), side.repartition(tasks, key)
