"""Shared model inputs: chronological split, encoding, and the names of encoded features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMERIC = [
    "obs_recency_days",
    "obs_frequency_orders",
    "obs_monetary_value",
    "obs_avg_order_value",
    "obs_customer_age_days",
    "obs_total_items",
    "obs_avg_items_per_order",
    "obs_avg_freight",
    "obs_avg_delivery_days",
    "obs_avg_delivery_delay",
    "obs_late_delivery_ratio",
    "obs_avg_installments",
    "obs_avg_review_score",
    "obs_review_count",
]
CATEGORICAL = ["customer_state", "obs_preferred_payment"]
SEED = 42


def chronological_split(features: DataFrame, split_date: str) -> tuple[DataFrame, DataFrame]:
    """Train on customers first seen before the date, test on the rest."""
    first = F.col("first_purchase_date")
    return features.filter(first < split_date), features.filter(first >= split_date)


def filled(df: DataFrame) -> DataFrame:
    """Missing numbers to 0, missing categories to Unknown."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC}
        | {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in CATEGORICAL}
    )


def fit_encoder(train: DataFrame) -> PipelineModel:
    """Scaler and one-hot encoder fitted on the training rows only.

    The indexer keeps unseen categories in an extra last slot, which the encoder drops: an
    unseen category is all zeros.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL]
    hot = [f"{c}_hot" for c in CATEGORICAL]
    stages = [
        VectorAssembler(inputCols=NUMERIC, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=["scaled", *hot], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(filled(train))


def encode(encoder: PipelineModel, df: DataFrame) -> DataFrame:
    extra = ["numbers", "scaled", *[f"{c}_index" for c in CATEGORICAL], *[f"{c}_hot" for c in CATEGORICAL]]
    return encoder.transform(filled(df)).drop(*extra)


def feature_names(encoder: PipelineModel) -> list[str]:
    """Names in vector order: numeric columns, then column_value per known category."""
    labels = encoder.stages[2].labelsArray
    return NUMERIC + [f"{c}_{v}" for c, values in zip(CATEGORICAL, labels) for v in values]


def importances(df: DataFrame, model, names: list[str], top: int = 20) -> DataFrame:
    """The strongest features by importance or absolute coefficient (one entry per feature)."""
    weights = getattr(model, "featureImportances", None)
    values = weights.toArray() if weights is not None else [abs(x) for x in model.coefficients.toArray()]
    ranked = sorted(zip(names, map(float, values)), key=lambda p: (-p[1], p[0]))[:top]
    rows = F.array(*[F.struct(F.lit(i + 1).cast("long").alias("rank"), F.lit(n).alias("feature"), F.lit(round(v, 6)).alias("importance")) for i, (n, v) in enumerate(ranked)])
    return df.sparkSession.range(1).select(F.inline(rows))
