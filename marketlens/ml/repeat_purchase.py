"""Repeat-purchase propensity: classifiers, threshold choice on validation rows, lift."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl, ratio
from marketlens.functions.ordering import quantiles, running_totals
from marketlens.ml.encoding import SEED, chronological_split, encode, feature_names, fit_encoder, importances
from marketlens.sources.workspace import concurrently, stored

LABEL = "target_repeat_buyer"
THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 11)]


def stratified_split(train: DataFrame, key: str = "customer_unique_id") -> tuple[DataFrame, DataFrame]:
    """About 80/20 within each class by a hash of the key: the same rows on every run."""
    held = F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(5)) == 0
    return train.filter(~held), train.filter(held)


def class_weights(rows: DataFrame) -> DataFrame:
    """Balanced weights n / (2 n_class), and n_negative / n_positive for the positive class."""
    counts = rows.agg(F.count(F.lit(1)).alias("n"), count_if(F.col(LABEL) == 1).alias("pos"))  # one row
    positive = F.col(LABEL) == 1
    own = F.when(positive, F.col("pos")).otherwise(F.col("n") - F.col("pos"))
    return (
        rows.crossJoin(F.broadcast(counts))
        .withColumn("balanced", dbl("n") / (2.0 * own))
        .withColumn("scaled_positive", F.when(positive, (F.col("n") - F.col("pos")) / F.greatest(F.lit(1), F.col("pos"))).otherwise(1.0))
        .drop("n", "pos")
    )


def estimators(rows: int) -> dict[str, object]:
    return {
        "Logistic Regression": LogisticRegression(
            labelCol=LABEL, weightCol="balanced", maxIter=1000, regParam=1.0 / max(1, rows), standardization=False
        ),
        "Random Forest Classifier": RandomForestClassifier(
            labelCol=LABEL, weightCol="balanced", numTrees=100, maxDepth=6, seed=SEED
        ),
        "Gradient Boosting Classifier": GBTClassifier(labelCol=LABEL, maxIter=50, maxDepth=3, seed=SEED),
        "Weighted Gradient Boosting Classifier": GBTClassifier(
            labelCol=LABEL, weightCol="scaled_positive", maxIter=50, maxDepth=3, seed=SEED
        ),
    }


def scored(model, encoded: DataFrame) -> DataFrame:
    """Adds ``score``, the probability of the positive class."""
    named = model.setProbabilityCol("_prob").setRawPredictionCol("_raw").setPredictionCol("_pred")
    return named.transform(encoded).withColumn("score", vector_to_array("_prob")[1]).drop("_prob", "_raw", "_pred")


# ---- evaluation over (score, label) rows ---------------------------------------------------


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def threshold_scores(rows: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Precision, recall and F1 at each threshold, from one aggregation."""
    s, y = F.col("score"), F.col(LABEL) == 1
    aggs = [count_if(y).alias("pos")]
    for i, t in enumerate(thresholds):
        aggs += [count_if((s >= t) & y).alias(f"tp{i}"), count_if((s >= t) & ~y).alias(f"fp{i}")]
    rows_out = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                ratio(F.col(f"tp{i}"), F.col(f"tp{i}") + F.col(f"fp{i}")).alias("precision"),
                ratio(F.col(f"tp{i}"), F.col("pos")).alias("recall"),
                f1(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col("pos") - F.col(f"tp{i}")).alias("f1"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return rows.agg(*aggs).select(F.inline(rows_out))


def best_threshold(rows: DataFrame) -> DataFrame:
    """The lowest threshold with the best F1; 0.5 when no threshold finds a positive. One row."""
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("neg")))
    return threshold_scores(rows).agg(best.alias("b")).select(
        F.when(F.col("b.f1") > 0, -F.col("b.neg")).otherwise(0.5).alias("optimal_threshold"),
        F.round("b.f1", 4).alias("val_f1"),
    )


def ranking_metrics(rows: DataFrame) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum), from distinct scores."""
    per_score = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"), count_if(F.col(LABEL) == 1).alias("pos"))
    ranked = running_totals(per_score, [F.col("score").desc()], ["n", "pos"])
    pos, neg = dbl("pos"), dbl("n") - F.col("pos")
    total_pos, total_neg = dbl("total_pos"), dbl("total_n") - F.col("total_pos")
    neg_below = total_neg - (F.col("before_n") - F.col("before_pos")) - neg
    precision = (F.col("before_pos") + pos) / (F.col("before_n") + F.col("n"))
    one = ranked.agg(
        F.sum(pos * (neg_below + neg / 2.0)).alias("wins"),
        F.sum(pos * precision).alias("area"),
        F.max(total_pos).alias("p"),
        F.max(total_neg).alias("q"),
    )
    return one.select(
        F.round(ratio(F.col("wins"), F.col("p") * F.col("q"), None), 4).alias("roc_auc"),
        F.round(ratio(F.col("area"), F.col("p")), 4).alias("pr_auc"),
    )


def decision_metrics(rows: DataFrame, threshold: float) -> DataFrame:
    """Accuracy, precision, recall, F1 and the confusion matrix at a frozen threshold."""
    said, y = F.col("score") >= threshold, F.col(LABEL) == 1
    one = rows.agg(
        count_if(said & y).alias("tp"),
        count_if(said & ~y).alias("fp"),
        count_if(~said & y).alias("fn"),
        count_if(~said & ~y).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return one.select(
        F.round(ratio(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        F.round(ratio(tp, tp + fp), 4).alias("precision"),
        F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(f1(tp, fp, fn), 4).alias("f1_score"),
        "tp",
        "fp",
        "fn",
        "tn",
    )


def all_metrics(rows: DataFrame, threshold: float) -> DataFrame:
    return decision_metrics(rows, threshold).crossJoin(F.broadcast(ranking_metrics(rows)))  # one-row frames


def lift_top5(rows: DataFrame) -> DataFrame:
    """The rows at or above the 95th percentile score, against the overall rate."""
    cut = quantiles(rows, "score", {"cut": 0.95})
    top, y = F.col("score") >= F.col("cut"), F.col(LABEL) == 1
    one = rows.crossJoin(F.broadcast(cut)).agg(  # one row
        F.count(F.lit(1)).alias("n"),
        count_if(y).alias("pos"),
        count_if(top).alias("total_count"),
        count_if(top & y).alias("true_positives"),
        count_if(top & ~y).alias("false_positives"),
    )
    rate = F.round(ratio(F.col("true_positives"), F.col("total_count")), 4)
    return one.select(
        "total_count",
        "true_positives",
        "false_positives",
        rate.alias("precision"),
        F.round(ratio(rate, ratio(F.col("pos"), F.col("n"))), 2).alias("precision_lift"),
    )


# ---- training ------------------------------------------------------------------------------


@dataclass(frozen=True)
class RepeatRun:
    encoder: PipelineModel
    models: dict[str, object]
    comparison: DataFrame
    best: str
    threshold: float
    features: DataFrame

    @property
    def chosen(self):
        return self.models[self.best]

    def importance(self, top: int = 20) -> DataFrame:
        return importances(self.features, self.chosen, feature_names(self.encoder), top)

    def score_all(self) -> DataFrame:
        """Every customer with a probability and the label at the frozen threshold."""
        rows = encode(self.encoder, self.features)
        out = scored(self.chosen, rows).drop("features")
        return out.withColumn("predicted_repeat_buyer", (F.col("score") >= self.threshold).cast("int")).withColumn(
            "repeat_purchase_probability", F.round("score", 4)
        ).drop("score")


def train_repeat(features: DataFrame, split_date: str) -> RepeatRun:
    """Choose each model's threshold on held-out training rows, refit on all of them, and keep
    the model with the best average precision on the test rows."""
    features = stored(features, "repeat-features")
    train, test = chronological_split(features, split_date)
    encoder = fit_encoder(train)
    encoded = stored(encode(encoder, train), "repeat-encoded")
    part, held = stratified_split(encoded)
    part, full = stored(class_weights(part), "repeat-part"), stored(class_weights(encoded), "repeat-train")
    tested = stored(encode(encoder, test), "repeat-test")
    part_n, full_n = part.count(), full.count()
    trial, final = estimators(part_n), estimators(full_n)

    # The trial and the final fit of a model do not need each other: all run side by side.
    jobs = {f"trial {name}": (lambda n=name: best_threshold(scored(trial[n].fit(part), held)).first()) for name in trial}  # one row
    jobs |= {f"final {name}": (lambda n=name: final[n].fit(full)) for name in final}
    fits = concurrently(jobs)

    def judged(name: str) -> tuple[object, float, DataFrame]:
        chosen, model = fits[f"trial {name}"], fits[f"final {name}"]
        threshold = chosen["optimal_threshold"]
        rows = stored(scored(model, tested).select("score", LABEL), "test-scores")
        lift = lift_top5(rows)
        lift = lift.withColumnsRenamed({c: f"top5_{c}" for c in lift.columns})
        metrics = all_metrics(rows, threshold).crossJoin(F.broadcast(lift))  # one-row frames
        named = metrics.select(
            F.lit(name).alias("model"),
            F.lit(threshold).alias("optimal_threshold"),
            F.lit(chosen["val_f1"]).cast("double").alias("val_f1"),
            "*",
        )
        return model, threshold, named

    fitted = concurrently({name: (lambda n=name: judged(n)) for name in final})
    models = {name: model for name, (model, _, _) in fitted.items()}
    thresholds = {name: threshold for name, (_, threshold, _) in fitted.items()}
    comparison = reduce(DataFrame.unionByName, [frame for _, _, frame in fitted.values()])
    comparison = stored(comparison, "repeat-comparison")
    quality = {r["model"]: r["pr_auc"] for r in comparison.collect()}  # one row per model
    best = max(models, key=lambda name: quality[name])
    return RepeatRun(encoder, models, comparison, best, thresholds[best], features)


