"""Exact ranks, running totals and quantiles without a single-task window.

``Window.orderBy`` with no partition, and the exact ``percentile`` aggregate, both pull
every row (or every distinct value) of a group into one task. Everything here instead

1. aggregates the rows to one row per distinct value (map-side combined, so a value shared
   by a third of all rows costs one row per map task),
2. writes those in range-partitioned order: each file is one contiguous, even stretch, and
   the file numbers sort like the stretches,
3. turns per-file totals (one row per file) into running offsets, and
4. opens windows only inside a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import dbl, sample_skewness
from marketlens.sources.workspace import stored_in_order

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def distinct_values(
    rows: DataFrame, value: str, groups: Sequence[str] = (), measures: dict[str, Column] | None = None
) -> DataFrame:
    """One row per (groups, value) with ``n`` rows and any extra summed measures."""
    extra = [c.alias(name) for name, c in (measures or {}).items()]
    return rows.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"), *extra)


def _offsets(placed: DataFrame, groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per (groups, file): its totals, those of all earlier files, and the group's."""
    sums = placed.groupBy(*groups, "_file").agg(*[F.sum(m).alias(f"_in_{m}") for m in measures])
    before = Window.partitionBy(*groups).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    return sums.select(
        *groups,
        "_file",
        *[F.col(f"_in_{m}") for m in measures],
        *[F.coalesce(F.sum(f"_in_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_in_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )


def _join_offsets(placed: DataFrame, offsets: DataFrame, groups: Sequence[str]) -> DataFrame:
    # Without groups there is one row per written file; with groups the planner decides.
    return placed.join(offsets if groups else F.broadcast(offsets), [*groups, "_file"])


def _before(measure: str, groups: Sequence[str], order: Sequence[Column | str]) -> Column:
    earlier = Window.partitionBy(*groups, "_file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.col(f"_off_{measure}") + F.coalesce(F.sum(measure).over(earlier), F.lit(0))


def running_totals(
    values: DataFrame, keys: Sequence[Column | str], measures: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Add ``before_<m>`` (sum over all earlier rows) and ``total_<m>`` for each measure.

    ``keys`` must order the rows of a group totally.
    """
    placed = stored_in_order(values, [*groups, *keys], "running")
    joined = _join_offsets(placed, _offsets(placed, groups, measures), groups)
    return joined.select(
        *values.columns,
        *[_before(m, groups, keys).alias(f"before_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def _position(p: float) -> Column:
    return (F.col("total_n") - 1) * F.lit(float(p))


def ranked_quantiles(ranked: DataFrame, value: str, probs: dict[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """Quantiles from (groups, value, n, before_n, total_n) rows, as ``running_totals`` gives."""

    def at(pos: Column) -> Column:
        inside = (pos >= F.col("before_n")) & (pos < F.col("before_n") + F.col("n"))
        return F.max(F.when(inside, dbl(value)))

    aggs, outs = [], []
    for name, p in probs.items():
        pos = _position(p)
        aggs += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
        frac = pos - F.floor(pos)
        outs.append((F.col(f"_lo_{name}") * (1.0 - frac) + F.col(f"_hi_{name}") * frac).alias(name))
    return ranked.groupBy(*groups).agg(F.max("total_n").alias("total_n"), *aggs).select(*groups, *outs)


def _pick_quantiles(placed: DataFrame, value: str, probs: dict[str, float], groups: Sequence[str]) -> DataFrame:
    """Quantiles from an ordered table of (groups, value, n). Only files holding a wanted
    position are sorted; the others contribute a count."""
    wanted = F.lit(False)
    for p in probs.values():
        for pos in (F.floor(_position(p)), F.ceil(_position(p))):
            wanted = wanted | ((pos >= F.col("_off_n")) & (pos < F.col("_off_n") + F.col("_in_n")))
    hit = _join_offsets(placed, _offsets(placed, groups, ["n"]).filter(wanted), groups)
    return ranked_quantiles(hit.withColumn("before_n", _before("n", groups, [value])), value, probs, groups)


def quantiles(rows: DataFrame, value: str, probs: dict[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles of a row-level column, nulls ignored."""
    values = distinct_values(rows.filter(F.col(value).isNotNull()), value, groups)
    return _pick_quantiles(stored_in_order(values, [*groups, value], "values"), value, probs, groups)


def weighted_quantiles(values: DataFrame, value: str, count: str, probs: dict[str, float]) -> DataFrame:
    """As ``quantiles``, from rows that already carry how often each value occurs."""
    counted = values.filter(F.col(value).isNotNull()).select(value, F.col(count).alias("n"))
    return _pick_quantiles(stored_in_order(counted, [value], "values"), value, probs, ())


def describe(
    rows: DataFrame, value: str, groups: Sequence[str] = (), probs: dict[str, float] | None = None
) -> DataFrame:
    """n, null_count, total, mean, std, min, max, skewness and quantiles, one row per group.

    The rows are read once, into one row per distinct value; the moments (two-pass, so free
    of cancellation) and the quantiles both come from that.
    """
    probs = QUARTILES if probs is None else probs
    placed = stored_in_order(distinct_values(rows, value, groups), [*groups, value], "values")
    # A null value keeps its own row and only feeds null_count.
    v, n = F.col(value), F.col("n")
    held = F.when(v.isNotNull(), n)
    first = placed.groupBy(*groups).agg(
        F.coalesce(F.sum(held), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("null_count"),
        dbl(F.sum(v * n)).alias("total"),
        dbl(F.min(v)).alias("min"),
        dbl(F.max(v)).alias("max"),
    )
    first = first.withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n")))
    centre = first.select(*groups, F.col("mean").alias("_mean"))
    centred = (
        placed.join(centre, list(groups)) if groups else placed.crossJoin(F.broadcast(centre))
    ).withColumn("_d", dbl(v) - F.col("_mean"))
    second = centred.groupBy(*groups).agg(
        F.sum(n * F.col("_d") * F.col("_d")).alias("_m2"),
        F.sum(n * F.col("_d") * F.col("_d") * F.col("_d")).alias("_m3"),
    )
    q = _pick_quantiles(placed.filter(v.isNotNull()), value, probs, groups)
    if groups:
        out = first.join(second, list(groups), "left").join(q, list(groups), "left")
    else:  # three one-row frames
        out = first.join(F.broadcast(second), F.lit(True), "left").join(F.broadcast(q), F.lit(True), "left")
    cnt = dbl("n")
    g1 = F.when(F.col("_m2") > 0, F.sqrt(cnt) * F.col("_m3") / F.pow(F.col("_m2"), 1.5))
    return out.select(
        *groups,
        "n",
        "null_count",
        "total",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (cnt - 1))).otherwise(F.lit(0.0)).alias("std"),
        "min",
        *probs,
        "max",
        F.coalesce(sample_skewness(g1, F.col("n")), F.lit(0.0)).alias("skewness"),
    )


def rank_rows(rows: DataFrame, value: str, tie_breaker: str, descending: bool = True) -> DataFrame:
    """Add ``row_number``, ``before_value`` (sum of the values ahead), ``total_n``, ``total_value``.

    Order: value, then ``tie_breaker`` ascending. Both are range keys, so a value held by a
    third of all rows is cut by the tie-breaker and still spreads over the files.
    """
    keys = [F.col(value).desc() if descending else F.col(value).asc(), F.col(tie_breaker).asc()]
    counted = running_totals(rows.withColumn("n", F.lit(1).cast("long")), keys, ["n", value])
    return counted.select(
        *rows.columns,
        (F.col("before_n") + 1).alias("row_number"),
        F.col(f"before_{value}").alias("before_value"),
        F.col("total_n"),
        F.col(f"total_{value}").alias("total_value"),
    )


def ntile(row_number: Column, total: Column, tiles: int) -> Column:
    """NTILE from a known row number and row count: the first (total mod tiles) tiles are one larger."""
    k = row_number - 1
    size = F.floor(total / tiles)
    larger = total - size * tiles
    in_larger = larger * (size + 1)
    return (
        F.when(k < in_larger, F.floor(k / (size + 1)))
        .otherwise(larger + F.floor((k - in_larger) / F.greatest(size, F.lit(1))))
        .cast("long")
        + 1
    )
