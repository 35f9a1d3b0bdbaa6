"""The batch pipeline: stage, validate, break on CRITICAL, transform, load, record.

Each dataset stays one lazy plan from its staged raw table to its load. What returns to the
driver are report tables of a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.model import CURATED, PIPELINE_DATASETS
from marketlens.operators.clean import transform_batch, transform_dataset
from marketlens.operators.quality import (
    MAX_ERROR_RATE,
    CircuitBreaker,
    quality_batch,
    quality_report,
    quality_summary,
    require_no_critical,
)
from marketlens.plans.manifest import Manifest
from marketlens.plans.quarantine import Routed, route_all
from marketlens.sources.workspace import concurrently, stored
from marketlens.sources.writers import load_batch, load_table, table_exists


def staged(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables as Parquet: the checks and the transformation each scan only their columns."""
    return concurrently({n: (lambda n=n: stored(tables[n], f"raw-{n}")) for n in PIPELINE_DATASETS if n in tables})


def _metrics(spark: SparkSession, raw: Mapping[str, DataFrame], summary: DataFrame, loads: DataFrame | None) -> DataFrame:
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("rows_extracted")) for n, df in raw.items()],
    )
    out = counts.join(F.broadcast(summary.select("dataset", F.col("status").alias("validation"))), "dataset")  # one row per dataset
    if loads is None:
        zero = F.lit(0).cast("long")
        return out.withColumns({"attempted": zero, "inserted": zero, "skipped": zero, "loaded": F.lit(False)})
    loads = loads.withColumn("loaded", F.lit(True)).drop("verified")
    return out.join(F.broadcast(loads), "dataset", "left").fillna({"attempted": 0, "inserted": 0, "skipped": 0, "loaded": False})


def _with_quarantined(metrics: DataFrame, routed: Mapping[str, Routed]) -> DataFrame:
    """Rows as delivered and rows set aside, per dataset."""
    rows = [(n, r.total_rows, r.quarantined_rows) for n, r in routed.items()]
    counts = metrics.sparkSession.createDataFrame(rows, "dataset string, rows_extracted long, rows_quarantined long")
    return metrics.drop("rows_extracted").join(F.broadcast(counts), "dataset")  # one row per dataset


def _routed(
    raw: Mapping[str, DataFrame], quarantine: str, limit: float, manifest: Manifest | None
) -> dict[str, Routed]:
    try:
        return route_all(raw, quarantine, limit)
    except CircuitBreaker:
        if manifest:
            manifest.record("all", "QUARANTINE", "FAILED")
        raise


def overall(metrics: DataFrame) -> DataFrame:
    """SUCCESS, WARNING or FAILED over all datasets. One row."""
    bad = (F.col("validation") == "FAILED") | (F.col("inserted") + F.col("skipped") < F.col("attempted"))
    worst = F.max(F.when(bad, 2).when(F.col("validation") == "WARNING", 1).otherwise(0))
    return metrics.agg(
        F.when(worst == 2, "FAILED").when(worst == 1, "WARNING").otherwise("SUCCESS").alias("overall_status"),
        F.sum("rows_extracted").alias("rows_extracted"),
        F.sum("inserted").alias("rows_inserted"),
        F.count(F.lit(1)).alias("datasets"),
    )


def run_dataset(
    name: str,
    raw: DataFrame,
    target: str,
    context: Mapping[str, DataFrame] | None = None,
    manifest: Manifest | None = None,
    quarantine: str | None = None,
    error_limit: float = MAX_ERROR_RATE,
) -> DataFrame:
    """One dataset end to end: its metrics row. With ``quarantine`` as in ``run_all``, but orphans stay:
    its parents may not be at hand."""
    spark = raw.sparkSession
    raw, routed = stored(raw, f"raw-{name}"), {}
    if quarantine is not None:
        routed = _routed({name: raw}, quarantine, error_limit, manifest)
        raw = routed[name].valid
    summary = stored(quality_summary(quality_report(name, raw, context)), "quality")
    try:
        require_no_critical(summary)
    except CircuitBreaker:
        if manifest:
            manifest.record(name, "VALIDATE", "FAILED")
        raise
    loads = load_table(name, transform_dataset(name, raw, context), target)
    if manifest:
        manifest.record(name, "LOAD", "SUCCESS", target)
    metrics = _metrics(spark, {name: raw}, summary, loads)
    return _with_quarantined(metrics, routed) if routed else metrics


def run_all(
    tables: Mapping[str, DataFrame],
    target: str,
    manifest: Manifest | None = None,
    resume: bool = False,
    quarantine: str | None = None,
    error_limit: float = MAX_ERROR_RATE,
) -> DataFrame:
    """All datasets in dependency order: one metrics row each.

    With ``quarantine`` invalid rows are set aside in that folder before validation; only the others
    are validated and loaded. Nothing is loaded when their share of a dataset passes ``error_limit``.

    On resume everything is validated again. A dataset that the manifest records as loaded into
    this target, and that is there, is neither transformed for its own sake nor written again. The
    manifest is closed after a clean run.
    """
    raw = staged(tables)
    spark = next(iter(raw.values())).sparkSession
    routed = _routed(raw, quarantine, error_limit, manifest) if quarantine is not None else {}
    raw = {n: routed[n].valid for n in raw} if routed else raw
    recorded = manifest.completed(target) if manifest and resume else set()
    done = {n for n in recorded if n not in CURATED or table_exists(spark, f"{target}/{n}")}
    summary = stored(quality_summary(quality_batch(raw)), "quality")
    try:
        require_no_critical(summary)
    except CircuitBreaker:
        if manifest:
            manifest.record("all", "VALIDATE", "FAILED")
        raise
    ready = transform_batch(raw, keep=stored)
    todo = {n: df for n, df in ready.items() if n not in done}
    loads = load_batch(todo, target, on_loaded=(lambda n: manifest.record(n, "LOAD", "SUCCESS", target)) if manifest else None) if todo else None
    metrics = _metrics(spark, raw, summary, loads)
    metrics = stored(_with_quarantined(metrics, routed) if routed else metrics, "metrics")
    if manifest and overall(metrics).first()["overall_status"] in ("SUCCESS", "WARNING"):  # one row
        manifest.close()
    return metrics
