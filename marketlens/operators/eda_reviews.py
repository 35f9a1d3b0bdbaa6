"""Review reports: scores, text, satisfaction by dimension, correlations, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl, is_present, pct, ratio, year_month
from marketlens.functions.ordering import describe
from marketlens.operators.eda_delivery import arrived, delay_bucket, delivery_bucket
from marketlens.operators.eda_products import items_with_category
from marketlens.operators.reporting import by_sections, rounded_stats, top_rows

MIN_CATEGORY_REVIEWS = 10


def score_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per score (five rows): everything about the scores derives from it."""
    return reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Share of each score among all reviews, with the mean and median score."""
    counts = score_counts(reviews)
    s, n = F.col("review_score"), F.col("reviews")
    level = counts.agg(
        F.sum(n).alias("all_reviews"),
        ratio(F.sum(s * n), F.sum(F.when(s.isNotNull(), n))).alias("mean"),
        F.percentile(s, 0.5, n).alias("median"),  # at most one row per score
    )
    return counts.filter(s.isNotNull()).crossJoin(F.broadcast(level)).select(  # one row
        s.cast("long").alias("review_score"),
        "reviews",
        pct(n, F.col("all_reviews")).alias("percentage"),
        F.round("mean", 2).alias("average_review_score"),
        F.round("median", 2).alias("median_review_score"),
    )


def score_trend(reviews: DataFrame) -> DataFrame:
    s = F.col("review_score")
    return (
        reviews.groupBy(year_month("review_creation_date").alias("year_month"))
        .agg(F.round(ratio(F.sum(s), F.count(s)), 2).alias("average_score"), F.count("review_id").alias("review_count"))
        .filter(F.col("year_month").isNotNull())
    )


def text_presence(reviews: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    message = F.length("review_comment_message")
    return reviews.agg(
        pct(count_if(is_present("review_comment_title")), n).alias("percentage_with_title"),
        pct(count_if(is_present("review_comment_message")), n).alias("percentage_with_message"),
        F.round(ratio(F.sum(message), F.count(message)), 2).alias("average_message_length"),
    )


def text_lengths(reviews: DataFrame) -> DataFrame:
    """Length statistics of titles and messages, before trimming, nulls left out."""
    wide = reviews.select(
        F.length("review_comment_title").cast("long").alias("title"),
        F.length("review_comment_message").cast("long").alias("message"),
    )
    long = wide.unpivot([], ["title", "message"], "field", "length").filter(F.col("length").isNotNull())
    return rounded_stats(describe(long, "length", ["field"]), ["field"]).drop("null_count", "skewness")


def first_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Category of each order's first item (lowest item id, then product id)."""
    first = items.groupBy("order_id").agg(
        F.min(F.struct("order_item_id", "product_id")).alias("first")
    ).select("order_id", "first.product_id")
    return items_with_category(first, products).select("order_id", "effective_category")


def first_payment_type(payments: DataFrame) -> DataFrame:
    """Payment type of each order's first payment (lowest sequence number, then type)."""
    first = F.min(F.struct("payment_sequential", "payment_type"))
    return payments.groupBy("order_id").agg(first.alias("first")).select("order_id", "first.payment_type")


def review_base(
    reviews: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """Each review with its order's state, value, durations, buckets, category, payment type."""
    side = orders.select(
        "order_id",
        "customer_id",
        "order_value",
        "delivery_days",
        "delivery_delay_days",
        delivery_bucket().alias("delivery_time_bucket"),
        delay_bucket().alias("delivery_delay_bucket"),
    )
    per_order = side.join(first_category(items, products), "order_id", "left").join(
        first_payment_type(payments), "order_id", "left"
    )
    none = F.lit("Uncategorized")
    return (
        reviews.select("review_id", "order_id", "review_score")
        .join(per_order, "order_id", "left")
        .join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .withColumns(
            {
                "effective_category": F.coalesce("effective_category", none),
                "payment_type": F.coalesce("payment_type", none),
            }
        )
    )


DIMENSIONS = ["effective_category", "customer_state", "payment_type", "delivery_delay_bucket", "delivery_time_bucket"]


def satisfaction(base: DataFrame) -> DataFrame:
    """Mean score by each dimension: (dimension, key, score, reviews).

    The base is reduced to one row per combination of dimensions first, so the five groupings
    share one pass over the reviews.
    """
    s = F.col("review_score")
    cube = base.groupBy(*DIMENSIONS).agg(F.sum(s).alias("score_sum"), F.count(s).alias("scored"))
    out = by_sections(
        cube, {d: F.col(d) for d in DIMENSIONS}, [F.sum("score_sum").alias("score_sum"), F.sum("scored").alias("review_count")]
    )
    return out.select(
        F.col("section").alias("dimension"),
        "key",
        F.round(ratio(F.col("score_sum"), F.col("review_count"), None), 2).alias("average_score"),
        "review_count",
    )


def score_correlations(base: DataFrame) -> DataFrame:
    s = dbl("review_score")
    return base.agg(
        F.round(F.corr(s, F.col("delivery_delay_days")), 4).alias("score_vs_delay"),
        F.round(F.corr(s, F.col("delivery_days")), 4).alias("score_vs_delivery_time"),
        F.round(F.corr(s, dbl("order_value")), 4).alias("score_vs_order_value"),
    )


def category_ratings(base: DataFrame, n: int = 10, min_reviews: int = MIN_CATEGORY_REVIEWS) -> DataFrame:
    """Best and worst categories among those with ``min_reviews`` reviews (all categories if none has)."""
    s = F.col("review_score")
    cats = base.groupBy("effective_category").agg(
        F.round(ratio(F.sum(s), F.count(s), None), 2).alias("average_score"), F.count(s).alias("review_count")
    )
    most = cats.agg(F.max("review_count").alias("_most"))  # one row
    enough = F.col("review_count") >= min_reviews
    valid = cats.crossJoin(F.broadcast(most)).filter(enough | (F.col("_most") < min_reviews)).drop("_most")
    score, name = F.col("average_score"), F.col("effective_category")
    return top_rows(valid, "highest", [score.desc(), name], n).unionByName(
        top_rows(valid, "lowest", [score.asc(), name], n)
    )


def review_operational(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Sentiment counts, and reviewed orders over delivered ones (can pass 100 %)."""
    s = F.col("review_score")
    delivered = arrived(orders).agg(F.count(F.lit(1)).alias("delivered"))
    one = reviews.agg(
        F.count(F.lit(1)).alias("rows"),
        count_if(s >= 4).alias("positive"),
        count_if(s == 3).alias("neutral"),
        count_if(s <= 2).alias("negative"),
        F.countDistinct("order_id").alias("reviewed"),
    ).crossJoin(F.broadcast(delivered))  # one-row frames
    return one.select(
        F.col("positive").alias("positive_reviews_count"),
        F.col("neutral").alias("neutral_reviews_count"),
        F.col("negative").alias("negative_reviews_count"),
        pct(F.col("positive"), F.col("rows")).alias("positive_review_percentage"),
        F.col("delivered").alias("total_delivered_orders_count"),
        F.col("reviewed").alias("reviewed_orders_count"),
        pct(F.col("reviewed"), F.col("delivered")).alias("review_coverage_percentage"),
    )
