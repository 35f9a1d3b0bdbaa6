"""Product reports: categories, dimensions, performance, freight, translation coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import (
    count_if,
    dbl,
    effective_category,
    money,
    money_total,
    pct,
)
from marketlens.functions.ordering import describe, quantiles
from marketlens.functions.skew import join_by_frequency
from marketlens.operators.reporting import rounded_stats, top_rows
from marketlens.sources.workspace import stored

DIMENSIONS = {
    "weight_g": "product_weight_g",
    "volume_cm3": "product_volume_cm3",
    "length_cm": "product_length_cm",
    "width_cm": "product_width_cm",
    "height_cm": "product_height_cm",
}


def with_category(products: DataFrame) -> DataFrame:
    return products.withColumn("effective_category", effective_category())


def items_with_category(items: DataFrame, products: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Order items with the category (and further columns) of their product."""
    side = with_category(products).select("product_id", "effective_category", *columns)
    return items.join(side, "product_id", "left").withColumn(
        "effective_category", F.coalesce("effective_category", F.lit("Uncategorized"))
    )


def category_counts(products: DataFrame, n: int = 20) -> DataFrame:
    counts = with_category(products).groupBy("effective_category").agg(F.count(F.lit(1)).alias("products"))
    return top_rows(counts, "products", [F.col("products").desc(), F.col("effective_category")], n)


def category_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and items per category. Items are summed per product before the join."""
    per_product = items.groupBy("product_id").agg(
        F.sum(money("price")).alias("price"), F.count("order_id").alias("items")
    )
    return items_with_category(per_product, products).groupBy("effective_category").agg(
        money_total("price").alias("revenue"), F.sum("items").alias("order_item_count")
    )


def category_rank(items: DataFrame, products: DataFrame) -> DataFrame:
    best = Window.orderBy(F.col("revenue").desc(), "effective_category")  # one row per category
    return category_revenue(items, products).select(
        "effective_category", "revenue", F.row_number().over(best).cast("long").alias("revenue_rank")
    )


def dimension_values(products: DataFrame) -> DataFrame:
    """(dimension, value) rows."""
    wide = products.select(*[F.col(c).cast("double").alias(name) for name, c in DIMENSIONS.items()])
    return wide.unpivot([], list(DIMENSIONS), "dimension", "value")


def dimension_stats(products: DataFrame) -> DataFrame:
    return rounded_stats(describe(dimension_values(products), "value", ["dimension"]), ["dimension"])


def iqr_bounds(quartiles: DataFrame) -> DataFrame:
    spread = (F.col("q75") - F.col("q25")) * 1.5
    return quartiles.withColumn("low", F.col("q25") - spread).withColumn("high", F.col("q75") + spread)


def dimension_outliers(products: DataFrame) -> DataFrame:
    """Rows outside the 1.5 IQR fences, per dimension."""
    values = dimension_values(products)
    fences = iqr_bounds(quantiles(values, "value", {"q25": 0.25, "q75": 0.75}, ["dimension"]))
    v = F.col("value")
    out = (v < F.col("low")) | (v > F.col("high"))
    return (
        values.join(F.broadcast(fences), "dimension")  # one row per dimension
        .groupBy("dimension")
        .agg(
            count_if(out).alias("outlier_count"),
            pct(count_if(out), F.count("value")).alias("outlier_percentage"),
            F.round(F.max("low"), 2).alias("lower_bound"),
            F.round(F.max("high"), 2).alias("upper_bound"),
        )
    )


def product_performance(items: DataFrame) -> DataFrame:
    """Items, revenue and distinct orders per product."""
    per_order = items.groupBy("product_id", "order_id").agg(
        F.count("order_item_id").alias("items"), F.sum(money("price")).alias("price")
    )
    return per_order.groupBy("product_id").agg(
        F.sum("items").alias("items_sold"),
        money(F.sum("price")).alias("revenue"),
        F.count("order_id").alias("distinct_orders"),
    )


def top_products(items: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """Best sellers by revenue and by units; only the winners are joined to their category."""
    perf = product_performance(items)
    by_revenue = top_rows(perf, "revenue", [F.col("revenue").desc(), F.col("product_id")], n)
    by_units = top_rows(perf, "units", [F.col("items_sold").desc(), F.col("product_id")], n)
    # 2n rows on the small side.
    winners = F.broadcast(by_revenue.unionByName(by_units))
    named = with_category(products).select("product_id", "effective_category").join(winners, "product_id", "right")
    return named.select(
        "ranking",
        "rank",
        "product_id",
        "effective_category",
        "items_sold",
        F.round(dbl("revenue"), 2).alias("total_revenue"),
        "distinct_orders",
    )


def unsold_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Products that no item refers to: count, share, the ten smallest ids."""
    sold = items.select("product_id").distinct()
    unsold = products.join(sold, "product_id", "left_anti").select("product_id").distinct()
    counts = products.agg(F.count(F.lit(1)).alias("total")).crossJoin(  # one-row frames
        F.broadcast(unsold.agg(F.count(F.lit(1)).alias("unsold")))
    )
    sample = (
        unsold.orderBy("product_id").limit(10).agg(F.array_join(F.sort_array(F.collect_list("product_id")), ",").alias("sample_product_ids"))
    )
    return counts.crossJoin(F.broadcast(sample)).select(
        F.col("unsold").alias("unsold_count"), pct(F.col("unsold"), F.col("total")).alias("unsold_percentage"), "sample_product_ids"
    )


def revenue_per_product(items: DataFrame) -> DataFrame:
    revenue = items.groupBy("product_id").agg(money(F.sum(money("price"))).alias("revenue"))
    return rounded_stats(describe(revenue, "revenue"))


def freight_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """A hot product's items meet its category without being gathered."""
    side = with_category(products).select("product_id", "effective_category")
    rows = join_by_frequency(items.select("product_id", "freight_value"), side, "product_id", "left")
    rows = rows.withColumn("effective_category", F.coalesce("effective_category", F.lit("Uncategorized")))
    d = describe(rows, "freight_value", ["effective_category"], {"median": 0.5})
    return d.select(
        "effective_category",
        F.round("mean", 2).alias("avg_freight"),
        F.round("median", 2).alias("median_freight"),
        F.round("total", 2).alias("total_freight"),
        F.col("n").alias("order_items_count"),
    )


def freight_correlation(items: DataFrame, products: DataFrame) -> DataFrame:
    """Pearson correlation of an item's freight with the weight and the volume of its product.

    Size is the same for all items of a product, so each product gives its count, mean and spread of
    the freights: items are reduced before the join, and deviations are taken from the mean.
    """
    f = dbl("freight_value")
    sizes = {"freight_vs_weight": "product_weight_g", "freight_vs_volume": "product_volume_cm3"}
    per_product = items.groupBy("product_id").agg(F.count(f).alias("n"), F.avg(f).alias("f"), (F.var_pop(f) * F.count(f)).alias("within"))
    side = products.select("product_id", *[dbl(c).alias(c) for c in sizes.values()])
    rows = stored(per_product.filter("n > 0").join(side, "product_id"), "freight-products")

    def known(c: str, value: Column) -> Column:
        return F.when(F.col(c).isNotNull(), value)

    means, parts = [], []
    for i, c in enumerate(sizes.values()):
        count = F.sum(known(c, F.col("n")))
        means += [(F.sum(known(c, F.col("n") * F.col("f"))) / count).alias(f"mf{i}"), (F.sum(F.col("n") * F.col(c)) / count).alias(f"ms{i}")]
        df, ds = F.col("f") - F.col(f"mf{i}"), F.col(c) - F.col(f"ms{i}")
        parts += [F.sum(F.col("n") * df * ds).alias(f"both{i}"), F.sum(known(c, F.col("within") + F.col("n") * df * df)).alias(f"vf{i}"), F.sum(F.col("n") * ds * ds).alias(f"vs{i}")]
    sums = rows.crossJoin(F.broadcast(rows.agg(*means))).agg(*parts)  # one row
    return sums.select(
        *[F.round(F.try_divide(F.col(f"both{i}"), F.sqrt(F.col(f"vf{i}") * F.col(f"vs{i}"))), 4).alias(name) for i, name in enumerate(sizes)]
    )


def translation_coverage(products: DataFrame) -> DataFrame:
    """Run before untranslated categories are filled, else coverage is always complete."""
    per_pair = products.groupBy("product_category_name", "category_name_english").agg(F.count(F.lit(1)).alias("n"))
    name, english = F.col("product_category_name"), F.col("category_name_english")
    total = F.countDistinct(name)
    translated = count_if(name.isNotNull() & english.isNotNull())
    untranslated = F.countDistinct(F.when(english.isNull(), name))
    return per_pair.agg(
        total.alias("total_categories"),
        translated.alias("categories_with_translation"),
        untranslated.alias("missing_translations_count"),
        pct(translated, total).alias("category_coverage_percent"),
        pct(F.sum(F.when(english.isNotNull(), F.col("n")).otherwise(0)), F.sum("n")).alias("product_coverage_percent"),
    )


def missing_translations(products: DataFrame) -> DataFrame:
    """The categories without a translation, with their products."""
    gap = F.col("product_category_name").isNotNull() & F.col("category_name_english").isNull()
    return products.filter(gap).groupBy("product_category_name").agg(F.count(F.lit(1)).alias("products"))


def effective_categories(products: DataFrame) -> DataFrame:
    return with_category(products).select("product_id", "effective_category")
