"""The CSV extract of the index, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairpulse import schema
from pairpulse.config import EngineConfig


def read_index_csv(spark: SparkSession, path: str, cfg: EngineConfig | None = None) -> DataFrame:
    """Typed scan, oldest month first. A missing path is an error of the reader."""
    cfg = cfg or EngineConfig()
    return (spark.read.schema(schema.gold_schema(cfg.measure_type))
            .option("header", "true").option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST")
            .csv(path).orderBy("year_month"))
