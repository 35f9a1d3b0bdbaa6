"""RFM segmentation: log-scaled features, K-means, cluster quality, profiles, personas."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exprs import pct
from marketlens.functions.ordering import quantiles
from marketlens.ml.encoding import SEED
from marketlens.operators.features import most_frequent
from marketlens.sources.workspace import concurrently, stored

LOGS = {"log_recency": "recency_days", "log_frequency": "frequency_orders", "log_monetary": "monetary_value"}
SCALED = ["z_recency", "z_frequency", "z_monetary"]
CLUSTERS = 4


def scaling(features: DataFrame) -> DataFrame:
    """What the scaling learns, as one row: medians for gaps, means and population deviations of the logs."""
    row = None
    for c in ("recency_days", "monetary_value"):
        mid = quantiles(features, c, {f"mid_{c}": 0.5})
        row = mid if row is None else row.crossJoin(F.broadcast(mid))  # one row each
    row = stored(row, "medians")
    level = _logs(features, row).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in LOGS], *[F.stddev_pop(c).alias(f"dev_{c}") for c in LOGS]
    )
    return stored(row.crossJoin(F.broadcast(level)), "scaling")


def _logs(features: DataFrame, learnt: DataFrame) -> DataFrame:
    out = features.crossJoin(F.broadcast(learnt))  # one row
    out = out.withColumns({c: F.coalesce(c, f"mid_{c}") for c in ("recency_days", "monetary_value")})
    out = out.withColumn("frequency_orders", F.coalesce("frequency_orders", F.lit(1)))
    return out.withColumns({log: F.log1p(F.col(c)) for log, c in LOGS.items()})


def scaled_by(features: DataFrame, learnt: DataFrame) -> DataFrame:
    """Gaps filled (medians; frequency 1), log1p, then z-scores, all as ``scaling`` learnt them."""
    # A constant column has deviation 0 and is only centred.
    z = {
        name: (F.col(c) - F.col(f"mean_{c}")) / F.when(F.col(f"dev_{c}") > 0, F.col(f"dev_{c}")).otherwise(1.0)
        for name, c in zip(SCALED, LOGS)
    }
    return _logs(features, learnt).withColumns(z).drop(*learnt.columns)


def preprocess(features: DataFrame) -> DataFrame:
    """The features with logs and z-scores, by their own scaling."""
    return scaled_by(features, scaling(features))


def with_vector(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=SCALED, outputCol="features").transform(scaled)


def weighted_points(scaled: DataFrame) -> DataFrame:
    """The distinct points with ``n``, how many rows are at each: a fit reads equal rows as one."""
    counted = scaled.groupBy(*SCALED).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return stored(with_vector(counted).sortWithinPartitions(*SCALED), "points")


STARTS = 10


def fit_kmeans(points: DataFrame, ks: Sequence[int], starts: int = STARTS) -> dict[int, KMeansModel]:
    """For each k the model with the least inertia of several starts.

    Every running fit keeps a copy of the points in memory, so one pool holds the fits of all k.
    """

    def fit(k: int, i: int) -> KMeansModel:
        return KMeans(k=k, seed=SEED + i, maxIter=100, predictionCol="cluster", weightCol="n").fit(points)

    fits = concurrently({f"{k} {i}": (lambda k=k, i=i: fit(k, i)) for k in ks for i in range(starts)})
    return {k: min((fits[f"{k} {i}"] for i in range(starts)), key=lambda model: model.summary.trainingCost) for k in ks}


def cluster_quality(assigned: DataFrame) -> DataFrame:
    """Davies-Bouldin, Calinski-Harabasz and inertia from per-cluster aggregates. One row."""
    centres = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(z).alias(f"c_{z}") for z in SCALED])
    square = sum((F.pow(F.col(z) - F.col(f"c_{z}"), 2) for z in SCALED), F.lit(0.0))
    spread = (
        assigned.join(F.broadcast(centres), "cluster")  # k rows
        .groupBy("cluster")
        .agg(F.max("n").alias("n"), F.avg(F.sqrt(square)).alias("s"), F.sum(square).alias("w"), *[F.max(f"c_{z}").alias(z) for z in SCALED])
    )
    rows = spread.collect()  # k rows
    total, k = sum(r["n"] for r in rows), len(rows)
    within = sum(r["w"] for r in rows)
    middle = [sum(r["n"] * r[z] for r in rows) / total for z in SCALED]

    def gap(a, b) -> float:
        return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))

    at = [[r[z] for z in SCALED] for r in rows]
    between = sum(r["n"] * gap(p, middle) ** 2 for r, p in zip(rows, at))
    worst = [
        max((rows[i]["s"] + rows[j]["s"]) / (gap(at[i], at[j]) or math.inf) for j in range(k) if j != i) for i in range(k)
    ] if k > 1 else [0.0]
    ch = (between / (k - 1)) / (within / (total - k)) if k > 1 and within > 0 and total > k else 0.0
    return assigned.sparkSession.range(1).select(
        F.lit(round(sum(worst) / len(worst), 4)).alias("davies_bouldin_index"),
        F.lit(round(ch, 2)).alias("calinski_harabasz_score"),
        F.lit(round(within, 2)).alias("inertia"),
    )


def evaluate_k(scaled: DataFrame, low: int = 2, high: int = 6) -> DataFrame:
    """Cluster quality for each k. Silhouette is the squared-Euclidean one over all rows."""
    vectors = stored(with_vector(scaled).select(*SCALED, "features"), "vectors")
    ks = range(low, high + 1)
    models = fit_kmeans(weighted_points(vectors.select(*SCALED)), ks)

    def one(k: int) -> DataFrame:
        assigned = models[k].transform(vectors)
        silhouette = ClusteringEvaluator(predictionCol="cluster", metricName="silhouette").evaluate(assigned)
        named = [F.lit(k).cast("long").alias("k"), F.lit(round(silhouette, 4)).alias("silhouette_score")]
        return cluster_quality(assigned).select(*named, "*")

    parts = concurrently({str(k): (lambda k=k: one(k)) for k in ks})
    return reduce(DataFrame.unionByName, parts.values())


# The labels and bounds of the personas.
def persona(recency: Column, frequency: Column, revenue: Column) -> Column:
    return (
        F.when(frequency > 1.5, "Loyal Repeat Buyers")
        .when((recency < 180.0) & (revenue >= 100.0), "Recent / Promising One-Time Buyers")
        .when((recency >= 300.0) & (revenue >= 200.0), "At-Risk High-Value Single-Order Buyers")
        .when((recency >= 300.0) & (revenue < 100.0), "Hibernating Low-Value Casuals")
        .otherwise("Mid-Tier Occasional Buyers")
    )


def mode_of(assigned: DataFrame, column: str) -> DataFrame:
    counts = assigned.groupBy("cluster_id", column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("cluster_id").agg(most_frequent("n", column).alias(f"mode_{column}"))


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    """One row per cluster: size, means, most frequent payment method and tier, persona."""
    means = {
        "average_revenue": "total_revenue",
        "average_orders": "frequency_orders",
        "average_review_score": "avg_review_score",
        "average_delivery_delay": "avg_delivery_delay",
        "average_order_value": "avg_order_value",
        "average_recency": "recency_days",
    }
    base = assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("customer_count"), *[F.round(F.avg(c), 2).alias(name) for name, c in means.items()]
    )
    whole = F.sum("customer_count").over(Window.partitionBy())  # one row per cluster
    base = base.withColumn("customer_percentage", pct(F.col("customer_count"), whole))
    for c, name in (("preferred_payment_method", "preferred_payment_method"), ("customer_value_tier", "dominant_customer_value_tier")):
        base = base.join(mode_of(assigned, c).withColumnRenamed(f"mode_{c}", name), "cluster_id")
    return base.withColumn(
        "business_description", persona(F.col("average_recency"), F.col("average_orders"), F.col("average_revenue"))
    )


@dataclass(frozen=True)
class Segmentation:
    """``names``: cluster (of the model), cluster_id and cluster_description, one row per cluster."""

    model: KMeansModel
    learnt: DataFrame
    names: DataFrame
    segments: DataFrame
    profiles: DataFrame


def assigned_by(model: KMeansModel, learnt: DataFrame, names: DataFrame, features: DataFrame) -> DataFrame:
    """Each row with the cluster of the nearest centre, scaled as the model's own rows were."""
    rows = model.transform(with_vector(scaled_by(features, learnt))).drop("features")
    return rows.join(F.broadcast(names), "cluster").drop("cluster", *LOGS, *SCALED)  # k rows


def segment(features: DataFrame, k: int = CLUSTERS) -> Segmentation:
    """K-means with ids ordered by mean recency, then revenue, so labels are stable."""
    learnt = scaling(features)
    vectors = stored(with_vector(scaled_by(features, learnt)), "vectors")
    model = fit_kmeans(weighted_points(vectors.select(*SCALED)), [k])[k]
    assigned = stored(model.transform(vectors).drop("features"), "segments")
    order = assigned.groupBy("cluster").agg(F.avg("recency_days").alias("r"), F.avg("total_revenue").alias("m"))
    ids = order.select(
        "cluster", (F.row_number().over(Window.orderBy("r", "m", "cluster")) - 1).cast("long").alias("cluster_id")
    )  # k rows
    labelled = assigned.join(F.broadcast(ids), "cluster")
    profiles = stored(cluster_profiles(labelled), "profiles")
    names = ids.join(profiles.select("cluster_id", F.col("business_description").alias("cluster_description")), "cluster_id")
    names = stored(names, "cluster-names")
    segments = labelled.drop("cluster").join(F.broadcast(names.drop("cluster")), "cluster_id")
    return Segmentation(model, learnt, names, segments, profiles)


def persona_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("cluster_description").agg(F.count(F.lit(1)).alias("customers"))
