"""Dataset profiling: overview, missing values, duplicates, numeric and categorical statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import dbl, pct
from marketlens.functions.ordering import describe
from marketlens.operators.reporting import top_rows
from marketlens.sources.workspace import concurrently, stored

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t.startswith(NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(len(df.columns)).cast("long").alias("total_columns"))


def _per_column(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One aggregation over the rows, turned into one row per column."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(t).alias("data_type"),
                F.col(f"c{i}").alias("non_null_count"),
                (F.col("_rows") - F.col(f"c{i}")).alias("null_count"),
                F.col("_rows"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return one.select(F.inline(rows)).select("column", *[c.alias(k) for k, c in fields.items()])


def missing_values(df: DataFrame) -> DataFrame:
    return _per_column(
        df,
        {
            "missing_count": F.col("null_count"),
            "missing_percent": pct(F.col("null_count"), F.col("_rows")),
            "data_type": F.col("data_type"),
        },
    )


def data_types(df: DataFrame) -> DataFrame:
    names = ("data_type", "non_null_count", "null_count")
    return _per_column(df, {n: F.col(n) for n in names})


def duplicates(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Surplus copies of whole rows, and of keys. Rows are compared by all their values."""
    def surplus(cols: Sequence[str], name: str) -> DataFrame:
        per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))

    if keys:
        # Copies of a row share its key, so only rows of repeated keys are compared whole.
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        out = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("key_duplicate_rows"))
        again = stored(per_key.filter("n > 1").select(*[F.col(k).alias(f"_again_{k}") for k in keys]), "repeated-keys")
        match = reduce(Column.__and__, [df[k].eqNullSafe(again[f"_again_{k}"]) for k in keys])
        rows = df.join(again, match, "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
        exact = rows.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact_duplicate_rows"))
        out = out.crossJoin(F.broadcast(exact)).select("total_rows", "exact_duplicate_rows", "key_duplicate_rows")  # two one-row frames
    else:
        out = surplus(df.columns, "exact_duplicate_rows").withColumn("key_duplicate_rows", F.lit(0).cast("long"))
    return out.withColumn("exact_duplicate_percent", pct(F.col("exact_duplicate_rows"), F.col("total_rows")))


def numeric_statistics(df: DataFrame) -> DataFrame:
    """describe() of every numeric column, from one pass over the rows."""
    cols = numeric_columns(df)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    d = describe(wide.unpivot([], cols, "column", "value"), "value", ["column"])
    return d.select("column", F.col("n").alias("count"), "mean", "std", "min", "q25", "median", "q75", "max", F.round("skewness", 4).alias("skewness"), "null_count")


LONG_TEXT = 64  # characters above which values are counted by digest


def categorical_statistics(df: DataFrame) -> DataFrame:
    """Distinct values, mode (ties to the smallest), its frequency, and nulls per text column."""
    cols = text_columns(df)
    # Long texts are counted by a digest; the text itself is fetched for the modes alone.
    digest = [F.when(F.length(c) > LONG_TEXT, F.sha2(c, 256)).alias(c) for c in cols]
    short = [F.when(F.length(c) <= LONG_TEXT, F.col(c)).alias(f"_short_{c}") for c in cols]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_short_{c}").alias("value"), F.col(c).alias("digest")) for c in cols])
    each = df.select(*digest, *short).select(F.inline(pairs))
    values = stored(each.groupBy("column", "value", "digest").agg(F.count(F.lit(1)).alias("n")), "text-values")
    v, n = F.col("value"), F.col("n")
    known = v.isNotNull() | F.col("digest").isNotNull()
    held = F.when(known, n)
    # The mode as a minimum of (-count, value): combines on the map side, no window per column.
    most = values.groupBy("column").agg(F.max(held).alias("most"))  # one row per column
    stats = values.groupBy("column").agg(
        F.count(F.when(known, 1)).alias("unique_count"),
        F.sum(n).alias("rows"),
        F.coalesce(F.sum(F.when(~known, n)), F.lit(0)).alias("null_count"),
    )
    tied = values.join(F.broadcast(most.filter("most IS NOT NULL").withColumnRenamed("column", "_column")), (F.col("column") == F.col("_column")) & (n == F.col("most")))
    tied = stored(tied.filter(known).select("column", "value", "digest", "most"), "modes")
    short_mode = tied.groupBy("column").agg(F.min(v).alias("short"), F.max("most").alias("most"))
    out = stats.join(F.broadcast(short_mode), "column", "left")  # one row per column
    long_ties = tied.filter("digest IS NOT NULL").select(F.col("column").alias("_column"), F.col("digest").alias("_digest"))
    searched = {r["_column"] for r in long_ties.select("_column").distinct().collect()}  # the others' modes are short
    longest = reduce(
        DataFrame.unionByName,
        [df.sparkSession.createDataFrame([], "_c string, long string")]
        + [
            df.select(F.lit(c).alias("_c"), F.col(c).alias("_text"))
            .filter(F.length("_text") > LONG_TEXT)
            .join(long_ties, (F.col("_c") == F.col("_column")) & (F.sha2("_text", 256) == F.col("_digest")), "left_semi")
            .groupBy("_c")
            .agg(F.min("_text").alias("long"))
            for c in cols
            if c in searched
        ],
    )
    stats = out.join(F.broadcast(longest), F.col("column") == F.col("_c"), "left").withColumn(
        "mode", F.struct((-F.col("most")).alias("neg"), F.least("short", "long").alias("value"))
    )
    top = F.coalesce(-F.col("mode.neg"), F.lit(0))
    return stats.select(
        "column",
        "unique_count",
        F.col("mode.value").alias("top_value"),
        top.alias("top_frequency"),
        pct(top, F.col("rows")).alias("top_percent"),
        "null_count",
    )


def profile_full(df: DataFrame, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    out = {
        "overview": overview(df),
        "missing_values": missing_values(df),
        "duplicates": duplicates(df, keys),
        "data_types": data_types(df),
    }
    if numeric_columns(df):
        out["numeric_statistics"] = numeric_statistics(df)
    if text_columns(df):
        out["categorical_statistics"] = categorical_statistics(df)
    return out


def profile_report(name: str, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every profile section as tidy rows, ready for the JSON sink."""
    from marketlens.sources.writers import json_report

    return json_report(profile_full(df, keys)).select(F.lit(name).alias("dataset"), "*")


def profile_batch(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The reports of all tables. A table is written once, so its sections do not repeat the joins behind it, and
    tables are profiled side by side."""
    keys = keys or {}

    def one(name: str, df: DataFrame) -> DataFrame:
        return stored(profile_report(name, stored(df, "profiled"), keys.get(name, ())), "profile")

    parts = concurrently({n: (lambda n=n, df=df: one(n, df)) for n, df in tables.items()})
    return reduce(DataFrame.unionByName, parts.values())


# ---- data behind the charts ----------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins included."""
    x = dbl(column)
    span = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    placed = F.least(F.lit(bins - 1), F.floor((x - F.col("lo")) / width))
    index = F.when(width > 0, placed).otherwise(F.lit(0)).cast("long")
    counts = (
        df.filter(x.isNotNull()).crossJoin(F.broadcast(span)).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin").crossJoin(F.broadcast(span))
    return all_bins.join(F.broadcast(counts), "bin", "left").select(  # ``bins`` rows
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def top_categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counts, column, [F.col("n").desc(), F.col("value")], n)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise Pearson correlations over rows where both are present, in one aggregation."""
    cols = list(columns or numeric_columns(df))
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(dbl(a), dbl(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(F.col(f"p{i}"), 4).alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(rows))


def resample_sum(df: DataFrame, date_column: str, value_column: str, unit: str = "day") -> DataFrame:
    """Sum per calendar period from the first to the last, 0 where a period is empty."""
    sums = (
        df.filter(F.col(date_column).isNotNull())
        .groupBy(F.date_trunc(unit, date_column).cast("date").alias("period"))
        .agg(F.sum(value_column).alias("total"))
    )
    span = sums.agg(F.min("period").alias("a"), F.max("period").alias("b"))
    step = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}[unit]
    calendar = span.select(F.explode(F.expr(f"sequence(a, b, {step})")).alias("period"))
    return calendar.join(sums, "period", "left").select(
        F.date_format("period", "yyyy-MM-dd").alias("period"), F.coalesce("total", F.lit(0)).cast("double").alias("total")
    )
