"""The model store: fitted runs written to a folder, and loaded from it in another session.

Layout: ``clv``, ``repeat`` and ``segments`` hold their models, ``predictions`` the stored results of
all customers, ``metadata`` one row per compared model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.ml.clv import ClvRun, Hurdle, Regressor
from marketlens.ml.repeat_purchase import RepeatRun
from marketlens.ml.scoring import Models, known_customers
from marketlens.ml.segmentation import Segmentation
from marketlens.sources.writers import write_csv, write_parquet


def export_predictions(scored_rows: DataFrame, path: str) -> None:
    """Predictions as Parquet and CSV."""
    write_parquet(scored_rows, f"{path}/predictions.parquet")
    write_csv(scored_rows, f"{path}/predictions.csv")


def _save(stages: list, path: str) -> None:
    # A pipeline loads its stages by the class that each was saved with.
    PipelineModel(stages=stages).write().overwrite().save(path)


def _metadata(comparison: DataFrame, best: str, path: str) -> DataFrame:
    meta = comparison.withColumn("selected", F.col("model") == best)
    meta.write.mode("overwrite").json(f"{path}/metadata")
    return meta


def export_clv(run: ClvRun, path: str) -> DataFrame:
    """Predictions, encoder and chosen model; returns the metadata table that is stored with them."""
    export_predictions(run.score_all(), path)
    run.encoder.write().overwrite().save(f"{path}/encoder")
    best = run.chosen
    _save([best.classifier, best.regressor] if isinstance(best, Hurdle) else [best.model], f"{path}/model")
    return _metadata(run.comparison, run.best, path)


def export_repeat(run: RepeatRun, path: str) -> DataFrame:
    export_predictions(run.score_all(), path)
    run.encoder.write().overwrite().save(f"{path}/encoder")
    _save([run.chosen], f"{path}/model")
    return _metadata(run.comparison, run.best, path)


def export_segments(run: Segmentation, path: str) -> DataFrame:
    """Segments, centres, scaling and names of the clusters; returns the profiles that are stored with them."""
    export_predictions(run.segments, path)
    run.model.write().overwrite().save(f"{path}/model")
    run.learnt.write.mode("overwrite").parquet(f"{path}/scaling")
    run.names.write.mode("overwrite").parquet(f"{path}/names")
    run.profiles.write.mode("overwrite").json(f"{path}/metadata")
    return run.profiles


def fitted(clv: ClvRun, repeat: RepeatRun, segments: Segmentation) -> Models:
    """Fitted runs, ready to score requests with."""
    known = known_customers(segments.segments, clv.score_all(), repeat.score_all())
    return Models(clv.encoder, clv.chosen, repeat.encoder, repeat.chosen, segments.model, segments.learnt, segments.names, known)


def export_all(clv: ClvRun, repeat: RepeatRun, segments: Segmentation, path: str) -> None:
    export_clv(clv, f"{path}/clv")
    export_repeat(repeat, f"{path}/repeat")
    export_segments(segments, f"{path}/segments")


def load_models(spark: SparkSession, path: str) -> Models:
    """The models of a store, as any session can load them."""
    parts = PipelineModel.load(f"{path}/clv/model").stages
    clv = Hurdle(*parts) if len(parts) == 2 else Regressor(parts[0])
    tables = [spark.read.parquet(f"{path}/{part}/predictions.parquet") for part in ("segments", "clv", "repeat")]
    return Models(
        PipelineModel.load(f"{path}/clv/encoder"),
        clv,
        PipelineModel.load(f"{path}/repeat/encoder"),
        PipelineModel.load(f"{path}/repeat/model").stages[0],
        KMeansModel.load(f"{path}/segments/model"),
        spark.read.parquet(f"{path}/segments/scaling"),
        spark.read.parquet(f"{path}/segments/names"),
        known_customers(*tables),
    )


def models_info(spark: SparkSession, path: str) -> DataFrame:
    """The chosen models of a store: part, model and its measures as JSON."""
    rows = None
    for part in ("clv", "repeat"):
        meta = spark.read.json(f"{path}/{part}/metadata").filter("selected")
        one = meta.select(F.lit(part).alias("part"), "model", F.to_json(F.struct(*[c for c in meta.columns if c not in ("model", "selected")])).alias("measures"))
        rows = one if rows is None else rows.unionByName(one)
    profiles = spark.read.json(f"{path}/segments/metadata")
    counts = profiles.agg(F.count(F.lit(1)).alias("clusters"), F.sum("customer_count").alias("customers"))
    return rows.unionByName(counts.select(F.lit("segments").alias("part"), F.lit("K-means").alias("model"), F.to_json(F.struct("clusters", "customers")).alias("measures")))
