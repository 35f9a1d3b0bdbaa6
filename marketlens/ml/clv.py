"""Customer lifetime value: regressors over the temporal features, compared with baselines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import ratio
from marketlens.functions.ordering import quantiles
from marketlens.ml.encoding import SEED, chronological_split, encode, feature_names, fit_encoder, importances
from marketlens.operators.reporting import top_rows
from marketlens.sources.workspace import concurrently, stored

TARGET = "target_future_clv"
ZERO, MEAN = "Zero-Spend Baseline ($0 Naive)", "Mean-Spend Baseline (Train Mean)"


def ridge(train_rows: int, alpha: float = 1.0) -> LinearRegression:
    """Spark's loss is a mean, so the penalty alpha becomes alpha / n."""
    return LinearRegression(
        labelCol=TARGET, regParam=alpha / max(1, train_rows), elasticNetParam=0.0, standardization=False
    )


@dataclass(frozen=True)
class Regressor:
    """One fitted model; ``predict`` adds a non-negative ``out`` column."""

    model: object

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        scored = self.model.setPredictionCol("_spend").transform(df)
        return scored.withColumn(out, F.greatest(F.lit(0.0), F.col("_spend"))).drop("_spend")

    @property
    def weights(self):
        return self.model


@dataclass(frozen=True)
class Hurdle:
    """P(spend > 0) from a classifier times the non-negative spend of a regressor."""

    classifier: object
    regressor: object

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        chance = self.classifier.setProbabilityCol("_c").setRawPredictionCol("_r").setPredictionCol("_k")
        scored = self.regressor.setPredictionCol("_spend").transform(chance.transform(df))
        value = vector_to_array("_c")[1] * F.greatest(F.lit(0.0), F.col("_spend"))
        return scored.withColumn(out, value).drop("_c", "_r", "_k", "_spend")

    @property
    def weights(self):
        return self.regressor


def fit_hurdle(train: DataFrame, min_buyers: int = 6) -> Hurdle:
    """The regressor sees only buyers, or everyone when there are fewer than ``min_buyers``."""
    flagged = train.withColumn("_buys", (F.col(TARGET) > 0).cast("double"))
    classifier = GBTClassifier(labelCol="_buys", maxIter=50, maxDepth=3, seed=SEED).fit(flagged)
    buyers = train.filter(F.col(TARGET) > 0)
    n = buyers.count()
    rows, n = (buyers, n) if n >= min_buyers else (train, train.count())
    return Hurdle(classifier, ridge(n).fit(rows))


def fit_models(train: DataFrame) -> dict[str, Regressor | Hurdle]:
    n = train.count()
    forest = RandomForestRegressor(labelCol=TARGET, numTrees=100, maxDepth=6, featureSubsetStrategy="all", seed=SEED)
    boosted = GBTRegressor(labelCol=TARGET, maxIter=50, maxDepth=3, seed=SEED)
    return concurrently(
        {
            "Ridge Regression": lambda: Regressor(ridge(n).fit(train)),
            "Random Forest Regressor": lambda: Regressor(forest.fit(train)),
            "Gradient Boosting Regressor": lambda: Regressor(boosted.fit(train)),
            "Hurdle Model (Two-Stage GBDT+Ridge)": lambda: fit_hurdle(train),
        }
    )


# ---- evaluation ----------------------------------------------------------------------------


def regression_metrics(predictions: DataFrame, columns: dict[str, str]) -> DataFrame:
    """MAE, RMSE, R2, median and non-zero absolute error per prediction column, in one pass.

    ``columns`` maps a model's name to its prediction column.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("predicted")) for n, c in columns.items()])
    long = predictions.select(F.col(TARGET).cast("double").alias("y"), F.inline(pairs))
    y, error = F.col("y"), F.col("y") - F.col("predicted")
    bought = y > 0
    long = long.withColumn("error", F.abs(error))
    sums = long.groupBy("model").agg(
        F.avg("error").alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(error * error).alias("residual"),
        (F.var_pop(y) * F.count(y)).alias("spread"),
        F.coalesce(F.avg(F.when(bought, F.col("error"))), F.lit(0.0)).alias("non_zero"),
    )
    median = quantiles(long, "error", {"median": 0.5}, ["model"])
    zero = F.col("model") == ZERO  # reported as 0 by definition
    return sums.join(median, "model").select(
        "model",
        F.round("mae", 4).alias("mae"),
        F.round("rmse", 4).alias("rmse"),
        F.when(zero, 0.0).otherwise(F.round(1.0 - ratio(F.col("residual"), F.col("spread"), None), 4)).alias("r2_score"),
        F.when(zero, 0.0).otherwise(F.round("median", 4)).alias("median_absolute_error"),
        F.round("non_zero", 4).alias("non_zero_clv_mae"),
    )


def with_baselines(train: DataFrame, test: DataFrame) -> DataFrame:
    """Zero and train-mean predictions next to every test row."""
    mean = train.agg(F.coalesce(F.avg(TARGET), F.lit(0.0)).alias("p_mean"))  # one row
    return test.crossJoin(F.broadcast(mean)).withColumn("p_zero", F.lit(0.0))


def baseline_metrics(features: DataFrame, split_date: str) -> DataFrame:
    train, test = chronological_split(features, split_date)
    return regression_metrics(with_baselines(train, test), {ZERO: "p_zero", MEAN: "p_mean"})


@dataclass(frozen=True)
class ClvRun:
    encoder: PipelineModel
    models: dict[str, Regressor | Hurdle]
    comparison: DataFrame
    best: str
    features: DataFrame

    @property
    def chosen(self) -> Regressor | Hurdle:
        return self.models[self.best]

    def importance(self, top: int = 20) -> DataFrame:
        return importances(self.features, self.chosen.weights, feature_names(self.encoder), top)

    def score_all(self) -> DataFrame:
        """Every customer scored with the train-fitted encoder, with the error."""
        scored = self.chosen.predict(encode(self.encoder, self.features), "predicted_clv").drop("features")
        scored = scored.withColumn("predicted_clv", F.round("predicted_clv", 2))
        return scored.withColumn("clv_error", F.round(F.col("predicted_clv") - F.col(TARGET), 2))


def train_clv(features: DataFrame, split_date: str) -> ClvRun:
    """Fit all models on early customers and choose the one with the lowest test MAE."""
    features = stored(features, "clv-features")
    train, test = chronological_split(features, split_date)
    encoder = fit_encoder(train)
    models = fit_models(stored(encode(encoder, train), "clv-train"))
    scored = encode(encoder, with_baselines(train, test))
    columns = {ZERO: "p_zero", MEAN: "p_mean"}
    for i, (name, model) in enumerate(models.items()):
        scored = model.predict(scored, f"p_{i}")
        columns[name] = f"p_{i}"
    comparison = stored(regression_metrics(scored, columns), "clv-comparison")
    mae = {r["model"]: r["mae"] for r in comparison.collect()}  # one row per model
    best = min(models, key=lambda name: mae[name])
    return ClvRun(encoder, models, comparison, best, features)


def extreme_errors(scored: DataFrame, n: int = 5) -> DataFrame:
    """The n largest over- and under-predictions."""
    cols = scored.select("customer_unique_id", "obs_monetary_value", TARGET, "predicted_clv", "clv_error")
    error, key = F.col("clv_error"), F.col("customer_unique_id")
    return top_rows(cols, "over", [error.desc(), key], n).unionByName(top_rows(cols, "under", [error.asc(), key], n))


def top_customers(scored: DataFrame, n: int = 10) -> DataFrame:
    cols = scored.select("customer_unique_id", "customer_state", "predicted_clv")
    return top_rows(cols, "clv", [F.col("predicted_clv").desc(), F.col("customer_unique_id")], n)
