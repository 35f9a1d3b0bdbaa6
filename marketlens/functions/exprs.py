"""Column expressions shared by the operators.

Rounding is half-up, divisions are guarded, and money is summed as DECIMAL so that
totals do not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"
SECONDS_PER_DAY = 86_400
MICROS_PER_DAY = 86_400_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY_TYPE)


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def total(c: Column | str) -> Column:
    """Sum with 0 for an empty or all-null group."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def money_total(c: Column | str, digits: int = 2) -> Column:
    return F.round(dbl(total(money(c))), digits)


def money_mean(c: Column | str) -> Column:
    """Mean over non-null values, from an exact decimal sum."""
    return dbl(F.sum(money(c))) / F.count(money(c))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """numerator / denominator, or the default where the denominator is not positive."""
    out = F.when(denominator > 0, dbl(numerator) / dbl(denominator))
    return out if default is None else out.otherwise(F.lit(default))


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(ratio(numerator, denominator) * 100.0, digits)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Fractional days from start to end; null when either is null."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(float(MICROS_PER_DAY))


def year_month(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def year_quarter(ts: Column | str) -> Column:
    return F.concat(F.year(col(ts)).cast("string"), F.lit("Q"), F.quarter(col(ts)).cast("string"))


def strip_ws(c: Column | str) -> Column:
    """Strip any leading/trailing Unicode whitespace (SQL trim strips spaces only)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def is_present(c: Column | str) -> Column:
    return col(c).isNotNull() & (strip_ws(c) != "")


def title_case(c: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    initcap only restarts after whitespace, so ``bed_bath`` would stay ``Bed_bath``.
    """
    words = F.split(col(c), r"(?<=[^\p{L}])")
    cased = F.transform(
        words,
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w)))),
    )
    return F.array_join(cased, "")


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer input is kept whole (lpad would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def right_closed_bucket(c: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Label of the first edge with value <= edge; ``last`` above all edges; null for null."""
    out = None
    for edge, label in edges:
        cond = c <= F.lit(edge)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.when(c.isNotNull(), last)


def sample_skewness(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness from the population skewness; 0 for fewer than 3 values."""
    n = dbl(n)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(F.lit(0.0))


def effective_category(english: str = "category_name_english", original: str = "product_category_name") -> Column:
    return F.coalesce(F.col(english), F.col(original), F.lit("Uncategorized"))
