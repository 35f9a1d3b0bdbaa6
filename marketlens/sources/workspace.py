"""Stored intermediates: cut lineage by writing a table to the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of intermediates: they cross the network and the disk twice, so size counts for more than speed.
COMPRESSION = "zstd"
_SETTING = "spark.checkpoint.dir"
_local_dir: str | None = None

T = TypeVar("T")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions."""
    global _local_dir
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder that every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="marketlens-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; with ``by`` in one folder per value.

    For a frame that several branches of one plan read: the branches then scan a small table
    instead of recomputing the joins behind it, and a lost executor costs a re-read.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).option("compression", COMPRESSION).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.select(*df.columns) if by else table  # the columns of the folders come last


def stored_in_order(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Like ``stored``, but range-partitioned and sorted, with the number of each row's file as ``_file``.

    Every file holds one contiguous stretch of the key order. The stretch is fixed once the
    table is written, so unlike a partition id it survives retries and re-planning.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("compression", COMPRESSION).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.select("*", part_number(F.col("_metadata.file_name")).alias("_file"))


def part_number(file_name: Column) -> Column:
    """The task that wrote a file. Names are padded to five digits only, so they do not sort like it."""
    return F.regexp_extract(file_name, r"^part-(\d+)", 1).cast("long")


def concurrently(jobs: Mapping[str, Callable[[], T]], width: int = 8) -> dict[str, T]:
    """Run independent Spark actions from a few driver threads, so small jobs overlap.

    The first failure is raised after the started jobs have ended.
    """
    # A thread of another such call has no session of its own.
    inherit = inheritable_thread_target(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(jobs)))) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in running.items()}
