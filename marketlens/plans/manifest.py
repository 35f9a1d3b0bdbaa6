"""The pipeline's progress table: one row per finished or failed stage, each in a folder of its own."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "dataset string, stage string, status string, target string, recorded_at timestamp"
CLOSED = "CLOSED"


@dataclass(frozen=True)
class Manifest:
    """Every event is a write of its own folder, so writers never share one and events of runs side by side all stay."""

    spark: SparkSession
    path: str

    def record(self, dataset: str, stage: str, status: str, target: str | None = None) -> None:
        row = self.spark.range(1).select(
            F.lit(dataset).alias("dataset"),
            F.lit(stage).alias("stage"),
            F.lit(status).alias("status"),
            F.lit(target).cast("string").alias("target"),
            F.current_timestamp().alias("recorded_at"),
        )
        row.coalesce(1).write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def rows(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.path)

    def completed(self, target: str) -> set[str]:
        """Datasets loaded into ``target`` since the manifest was last closed."""
        rows = self.rows()
        closed = rows.agg(F.max(F.when(F.col("status") == CLOSED, F.col("recorded_at"))).alias("closed"))  # one row
        loaded = (F.col("stage") == "LOAD") & (F.col("status") == "SUCCESS") & (F.col("target") == target)
        fresh = F.col("closed").isNull() | (F.col("recorded_at") > F.col("closed"))
        names = rows.filter(loaded).crossJoin(F.broadcast(closed)).filter(fresh).select("dataset").distinct()
        return {r["dataset"] for r in names.collect()}  # at most one row per dataset

    def close(self) -> None:
        self.record("all", "RUN", CLOSED)
