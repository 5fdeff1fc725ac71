"""Where intermediate results live, and how a layer is computed exactly once.

A layer is written to a scratch table first, checked there, and published from there.
The rows checked are the rows published, the report reads a few columns of Parquet
instead of running the layer again, and a lost executor costs no recomputation of what
was already staged.
"""

from __future__ import annotations

import gc
import time
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; without it, one below the
    warehouse, which all executors share too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _stage_database(spark: SparkSession) -> str:
    """``pairpulse_stage``; one of its own for a scratch folder below which that is not, as a
    catalog that lasts keeps the folder of a database."""
    root, name = scratch_root(spark), "pairpulse_stage"

    def create() -> bool:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}'")
        return _plain(spark.catalog.getDatabase(name).locationUri) == _plain(f"{root}/{name}")

    if not create():
        name = f"pairpulse_stage_{zlib.crc32(root.encode()):08x}"
        create()
    return name


def _plain(uri: str) -> str:
    """A location without the scheme that the catalog puts before local paths."""
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith(("file:", "/")) else uri


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles that no frame needs any more deleted now. Spark deletes them
    when the driver's heap is collected, which may be long after the next step has filled the
    disks. What has just ended is still held by listeners when the first collection comes."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.5)
    spark._jvm.System.gc()


def size_of(rows: DataFrame) -> int:
    """Bytes of the files that are read for rows, as the optimizer takes them."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stage(df: DataFrame, label: str) -> str:
    """Write ``df`` to a new scratch table and return its name."""
    name = f"{_stage_database(df.sparkSession)}.{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return name


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows of ``df``, computed once; dropped when the block ends."""
    spark = df.sparkSession
    name = stage(df, label)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def staged_and_counted(df: DataFrame, label: str,
                       metrics: dict[str, Column]) -> Iterator[tuple[DataFrame, dict[str, Any]]]:
    """``staged``, and aggregates over its rows that are taken while they are written.

    Rows are counted by the tasks that write them, each task once, so the counts are those
    of the staged table. Distinct aggregates are not possible here.
    """
    observation = Observation()
    watched = df.observe(observation, *[c.alias(n) for n, c in metrics.items()])
    with staged(watched, label) as rows:
        yield rows, observation.get
