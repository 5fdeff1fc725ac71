"""Expected file slots and what has arrived of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairpulse.config import SLOT_SUFFIX, EngineConfig
from pairpulse.functions.dates import Days, file_date, slot_digits
from pairpulse.sources.landing import landed_files


class NoInputError(RuntimeError):
    """A day to be loaded has no file at all; ``days`` are all such days."""

    def __init__(self, days: Collection[dt.date]) -> None:
        super().__init__(f"no file arrived for {', '.join(map(str, days))}")
        self.days = list(days)


def slot_name(cfg: EngineConfig, stamp: Column) -> Column:
    return F.concat(F.lit(cfg.slot_prefix), F.date_format(stamp, "yyyyMMddHHmmss"),
                    F.lit(SLOT_SUFFIX))


def expected_slots(days: DataFrame, cfg: EngineConfig, day: str = "day") -> DataFrame:
    """One row per quarter of an hour of every given day."""
    midnight = F.col(day).cast("timestamp_ntz")
    quarters = F.sequence(midnight, midnight + F.expr("INTERVAL '23:45' HOUR TO MINUTE"),
                          F.expr("INTERVAL 15 MINUTES"))
    return (days.select(F.col(day).alias("file_date"), F.explode(quarters).alias("slot_time"))
            .select("file_date", slot_name(cfg, F.col("slot_time")).alias("slot")))


def landed_slots(spark: SparkSession, landing: str, cfg: EngineConfig, days: Days | None = None,
                 archives: bool | None = None) -> DataFrame:
    """Slots present in the landing area: as archives, as plain files, or (None) either.
    Reads the listing, never the content."""
    files = landed_files(spark, landing, days)
    path = F.col("path")
    if archives is not None:
        files = files.filter(path.endswith(".zip") if archives else ~path.endswith(".zip"))
    stamped = files.select(file_date(path).alias("file_date"), slot_digits(path).alias("digits"))
    return (stamped.filter(F.col("file_date").isNotNull()).distinct()
            .select("file_date", F.concat(F.lit(cfg.slot_prefix), F.col("digits"),
                                          F.lit(SLOT_SUFFIX)).alias("slot")))


def missing_slots(expected: DataFrame, arrived: DataFrame) -> DataFrame:
    return expected.join(arrived.select("slot").distinct(), "slot", "left_anti").select(
        "file_date", "slot")


def arrivals_per_day(expected: DataFrame, arrived: DataFrame) -> DataFrame:
    """Expected, arrived and missing slots of every day."""
    seen = arrived.select("slot").distinct().withColumn("hit", F.lit(1))
    n_arrived = F.count("hit")
    return (expected.join(seen, "slot", "left").groupBy("file_date")
            .agg(F.count(F.lit(1)).alias("expected_slots"), n_arrived.alias("arrived_slots"),
                 (F.count(F.lit(1)) - n_arrived).alias("missing_slots")))


def require_arrivals(arrivals: DataFrame) -> None:
    """Partial days pass; a day without any file does not. The rows read here are days."""
    empty = [r.file_date for r in
             arrivals.filter("arrived_slots = 0").orderBy("file_date").collect()]
    if empty:
        raise NoInputError(empty)
