"""Batch scoring of requests: the stored result of a known customer, else the model's.

Models are fitted runs, or what ``marketlens.ml.store`` loads of them in another session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.ml.clv import Hurdle, Regressor
from marketlens.ml.encoding import CATEGORICAL, NUMERIC, encode
from marketlens.ml.repeat_purchase import scored
from marketlens.ml.segmentation import LOGS, assigned_by

# What a request that leaves a field out is scored with.
DEFAULTS = {
    "recency_days": 30.0,
    "frequency_orders": 1,
    "monetary_value": 150.0,
    "avg_order_value": 150.0,
    "customer_age_days": 100.0,
    "total_items": 1,
    "avg_items_per_order": 1.0,
    "avg_freight_value": 15.0,
    "avg_delivery_days": 10.0,
    "avg_delivery_delay": -5.0,
    "late_delivery_ratio": 0.0,
    "avg_installments": 2.0,
    "avg_review_score": 4.5,
    "review_count": 1,
    "state": "SP",
    "preferred_payment_method": "credit_card",
}
MODEL_INPUT = {
    "obs_avg_freight": "avg_freight_value",
    "customer_state": "state",
    "obs_preferred_payment": "preferred_payment_method",
}


#: The label of a request that the repeat-purchase model scores; stored labels have their run's threshold.
REQUEST_THRESHOLD = 0.5


@dataclass(frozen=True)
class Models:
    """What scoring needs. ``known``: one row per customer with its stored results and its ids."""

    clv_encoder: PipelineModel
    clv: Regressor | Hurdle
    repeat_encoder: PipelineModel
    repeat: object
    kmeans: KMeansModel
    learnt: DataFrame
    names: DataFrame
    known: DataFrame


KNOWN = ("cluster_id", "cluster_description", "predicted_clv", "repeat_purchase_probability", "predicted_repeat_buyer")


def _ids() -> Column:
    """Both ids of a customer's row, as text."""
    both = F.array(F.col("customer_unique_id").cast("string"), F.col("customer_id").cast("string"))
    return F.array_compact(F.array_distinct(both))


def known_customers(segments: DataFrame, clv: DataFrame, repeat: DataFrame) -> DataFrame:
    """The stored results of each customer side by side, with all ids that any table has for it.

    A customer may lack some of the results.
    """
    out = segments.select("customer_unique_id", _ids().alias("ids"), *KNOWN[:2])
    for table, columns in ((clv, KNOWN[2:3]), (repeat, KNOWN[3:])):
        named = table.select("customer_unique_id", _ids().alias("_more"), *columns)
        none = F.array().cast("array<string>")
        out = out.join(named, "customer_unique_id", "full")
        out = out.withColumn("ids", F.array_union(F.coalesce("ids", none), F.coalesce("_more", none))).drop("_more")
    return out


def _by_any_id(known: DataFrame) -> DataFrame:
    """One row per id under which a customer may be asked for; of several rows of one id the least."""
    either = known.select(F.explode("ids").alias("_key"), F.struct(*KNOWN).alias("_stored"))
    return either.groupBy("_key").agg(F.min("_stored").alias("_stored"))


def _field(requests: DataFrame, name: str) -> Column:
    """The given field of a request, else its default."""
    default = F.lit(DEFAULTS[name])
    return F.coalesce(F.col(name), default) if name in requests.columns else default


def request_features(requests: DataFrame) -> DataFrame:
    """Model input columns of a request."""
    inputs = {c: _field(requests, MODEL_INPUT.get(c, c.removeprefix("obs_"))) for c in NUMERIC + CATEGORICAL}
    return requests.select(*KEPT, *[v.alias(c) for c, v in inputs.items()], *[_field(requests, c).alias(c) for c in LOGS.values()])


#: What stays of a request beside the model inputs.
KEPT = ("request_id", "_stored")


def _asked(requests: DataFrame) -> Column:
    ids = [F.col(c).cast("string") for c in ("customer_id", "customer_unique_id") if c in requests.columns]
    return F.coalesce(*ids) if ids else F.lit(None).cast("string")


def score_requests(requests: DataFrame, models: Models) -> DataFrame:
    """One row per request: segment, lifetime value and repeat purchase, each with its source.

    A request is (request_id, optional customer_id and customer_unique_id, any feature fields).
    ``table`` results are those stored for the customer of the id, ``model`` results are computed
    from the fields: an unknown id, no id, or a customer without that result. Requests without an
    id, however many, do not take part in the lookup.
    """
    asked = requests.withColumn("_asked", _asked(requests))
    nothing = F.lit(None).cast(_by_any_id(models.known).schema["_stored"].dataType)
    named = asked.filter(F.col("_asked").isNotNull()).join(_by_any_id(models.known), F.col("_asked") == F.col("_key"), "left").drop("_key")
    anonymous = asked.filter(F.col("_asked").isNull()).withColumn("_stored", nothing)
    rows = request_features(named.unionByName(anonymous))

    rows = models.clv.predict(encode(models.clv_encoder, rows), "_clv").drop("features")
    rows = scored(models.repeat, encode(models.repeat_encoder, rows)).withColumnRenamed("score", "_chance").drop("features")
    near = assigned_by(models.kmeans, models.learnt, models.names, rows)

    def source(stored_column: str) -> Column:
        return F.when(F.col(f"_stored.{stored_column}").isNotNull(), "table").otherwise("model")

    fresh = (F.col("_chance") >= REQUEST_THRESHOLD).cast("int")
    return near.select(
        "request_id",
        F.coalesce("_stored.cluster_id", "cluster_id").alias("cluster_id"),
        F.coalesce("_stored.cluster_description", "cluster_description").alias("cluster_description"),
        source("cluster_id").alias("segment_source"),
        F.round(F.coalesce("_stored.predicted_clv", "_clv"), 2).alias("predicted_clv"),
        source("predicted_clv").alias("clv_source"),
        F.round(F.coalesce("_stored.repeat_purchase_probability", "_chance"), 4).alias("repeat_purchase_probability"),
        F.coalesce("_stored.predicted_repeat_buyer", fresh).alias("predicted_repeat_customer"),
        source("repeat_purchase_probability").alias("repeat_source"),
    )
