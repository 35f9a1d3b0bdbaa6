"""Mann-Whitney U and Kruskal-Wallis H from distributed, tie-averaged ranks.

Rows are reduced to counts per (value, group); ranks come from running totals over the
distinct values. Tail probabilities, for which SQL has no function, are column expressions
over the one-row statistic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl
from marketlens.functions.ordering import running_totals
from marketlens.sources.workspace import stored


def normal_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal, as phi(|z|) times Simpson's rule over exp(-|z| t - t^2 / 2).

    Taking the density out of the integral keeps tiny tails relatively exact.
    """
    a, step, last = F.abs(z), 0.003, 4000

    def weighted(acc: Column, i: Column) -> Column:
        t = i * step
        weight = F.when((i == 0) | (i == last), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return acc + weight * F.exp(-a * t - t * t / 2.0)

    area = F.aggregate(F.sequence(F.lit(0), F.lit(last)), F.lit(0.0), weighted) * (step / 3.0)
    tail = F.exp(-a * a / 2.0) / math.sqrt(2.0 * math.pi) * area
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def chi_square_tail(x: Column, freedom: int) -> Column:
    """P(X > x) for a chi-square: Q(a + 1, y) = Q(a, y) + y^a e^-y / gamma(a + 1), from a = 1/2 or 1."""
    y = x / 2.0
    a = 0.5 if freedom % 2 else 1.0
    tail = 2.0 * normal_tail(F.sqrt(x)) if freedom % 2 else F.exp(-y)
    while a < freedom / 2.0:
        tail = tail + F.exp(-y + a * F.log(y) - math.lgamma(a + 1))
        a += 1
    return F.when(x > 0, tail).when(x.isNotNull(), 1.0)


def _ranked(rows: DataFrame, value: str, groups: dict[str, Column]) -> DataFrame:
    """Per distinct value: its mid-rank, count, and count within each group."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("n"), *[count_if(c).alias(g) for g, c in groups.items()]
    )
    ranked = running_totals(counts, [F.col(value)], ["n"])
    return ranked.withColumn("mid_rank", dbl("before_n") + (F.col("n") + 1) / 2.0)


def _tie_sum() -> Column:
    n = dbl("n")
    return F.sum(n * n * n - n)


#: The exact distribution of U is used if one side has at most this many rows, the product of both
#: sides is at most EXACT_PAIRS, and no value is tied.
EXACT_ROWS = 8
EXACT_PAIRS = 20_000


def exact_counts(n1: int, n2: int) -> list[int]:
    """How many of the orders of n1 + n2 untied rows give each U from 0 to n1 * n2.

    The generating function is a product of (1 - q^(n2 + i)) / (1 - q^i) over i = 1 .. n1; each factor
    is one pass over the coefficients.
    """
    counts = [1] + [0] * (n1 * n2)
    for i in range(1, n1 + 1):
        for u in range(len(counts) - 1, n2 + i - 1, -1):
            counts[u] -= counts[u - n2 - i]
        for u in range(i, len(counts)):
            counts[u] += counts[u - i]
    return counts


def exact_p(u: float, n1: int, n2: int, alternative: str) -> float:
    """P(U <= u), or twice the smaller tail, if all orders are equally likely."""
    counts = exact_counts(n1, n2)
    below = round(u) if alternative == "less" else round(min(u, n1 * n2 - u))
    tail = sum(counts[: below + 1]) / sum(counts)
    return tail if alternative == "less" else min(1.0, 2.0 * tail)


def mann_whitney(rows: DataFrame, value: str, first: Column, alternative: str = "two-sided") -> DataFrame:
    """U of the rows where ``first`` holds against the others, and the rank-biserial effect size
    1 - 2U / (n1 n2).

    ``method`` says where p comes from: ``exact`` for small samples without ties (see EXACT_ROWS), else
    ``asymptotic``, the normal approximation with tie and continuity correction. With an empty side,
    or only one distinct value, nothing can differ: p is 1.
    """
    ranked = _ranked(rows, value, {"in_first": first})
    v = dbl(value)
    one = ranked.agg(
        F.sum("in_first").alias("n1"),
        (F.sum("n") - F.sum("in_first")).alias("n2"),
        F.sum(F.col("in_first") * F.col("mid_rank")).alias("rank_sum"),
        F.sum(v * F.col("in_first")).alias("sum1"),
        F.sum(v * (F.col("n") - F.col("in_first"))).alias("sum2"),
        _tie_sum().alias("ties"),
    )
    n1, n2 = dbl("n1"), dbl("n2")
    u, n = F.col("u_statistic"), n1 + n2
    mean = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    one = stored(one.withColumn("u_statistic", F.col("rank_sum") - n1 * (n1 + 1) / 2.0), "mann-whitney")
    if alternative == "less":
        z = F.try_divide(n1 * n2 - u - mean - 0.5, sigma)
        p = normal_tail(F.col("z"))
    elif alternative == "two-sided":
        z = F.try_divide(F.greatest(u, n1 * n2 - u) - mean - 0.5, sigma)
        p = F.least(F.lit(1.0), 2.0 * normal_tail(F.col("z")))
    else:
        raise ValueError(f"unknown alternative: {alternative}")
    row = one.first()  # one row
    a, b = row["n1"] or 0, row["n2"] or 0
    exact = 0 < min(a, b) <= EXACT_ROWS and a * b <= EXACT_PAIRS and not row["ties"]
    if exact:
        p = F.lit(exact_p(row["u_statistic"], a, b, alternative))
    return (
        one.withColumn("z", z)
        .withColumn("p_value", F.coalesce(p, F.lit(1.0)))
        .select(
            "n1",
            "n2",
            F.round(F.try_divide("sum1", n1), 2).alias("mean1"),
            F.round(F.try_divide("sum2", n2), 2).alias("mean2"),
            u,
            "p_value",
            F.round(1.0 - F.try_divide(2.0 * u, n1 * n2), 4).alias("effect_size_rank_biserial"),
            (F.col("p_value") < 0.05).alias("statistically_significant"),
            F.lit("exact" if exact else "asymptotic").alias("method"),
        )
    )


def kruskal_wallis(rows: DataFrame, value: str, group: str, groups: Sequence[str]) -> DataFrame:
    """H over the named groups (tie corrected) with its chi-square tail; null if a group is empty."""
    names = {f"g{i}": F.col(group) == g for i, g in enumerate(groups)}
    ranked = _ranked(rows.filter(F.col(group).isin(list(groups))), value, names)
    one = ranked.agg(
        F.sum("n").alias("n"),
        _tie_sum().alias("ties"),
        *[F.sum(g).alias(f"n_{g}") for g in names],
        *[F.sum(F.col(g) * F.col("mid_rank")).alias(f"r_{g}") for g in names],
        *[F.try_divide(F.sum(dbl(value) * F.col(g)), F.sum(g)).alias(f"mean_{g}") for g in names],
    )
    n = dbl("n")
    spread = F.lit(0.0)
    for g in names:
        spread = spread + F.try_divide(F.col(f"r_{g}") * F.col(f"r_{g}"), F.col(f"n_{g}"))
    untied = 1.0 - F.try_divide(F.col("ties"), n * n * n - n)
    h = F.try_divide(F.try_divide(F.lit(12.0), n * (n + 1)) * spread - 3.0 * (n + 1), untied)
    return (
        one.withColumn("h_statistic", h)
        .withColumn("p_value", chi_square_tail(F.col("h_statistic"), len(groups) - 1))
        .select(
            F.col("n").alias("observations"),
            "h_statistic",
            "p_value",
            (F.col("p_value") < 0.05).alias("statistically_significant"),
            *[F.round(f"mean_{g}", 2).alias(f"mean_{i + 1}") for i, g in enumerate(names)],
        )
    )
