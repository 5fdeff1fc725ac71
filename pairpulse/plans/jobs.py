"""One job per layer, for one day or any set of days. Rerunning a job is harmless."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse import schema
from pairpulse.config import EngineConfig
from pairpulse.functions.dates import Days, month_after
from pairpulse.operators import coverage, gold as gold_ops, quality
from pairpulse.operators.bronze import to_bronze
from pairpulse.operators.silver import to_silver
from pairpulse.sinks.staging import staged, staged_and_counted
from pairpulse.sinks.tables import (Lake, drop_partitions, partition_values, publish, publish_by_day, publish_silver,
                                    silver_of_months)
from pairpulse.sources import lines, slots


def days_frame(spark: SparkSession, days: Days) -> DataFrame:
    all_days = coverage.calendar(spark, days.start, days.end)
    return all_days.filter(days.contains(F.col("day")))


def check_arrivals(spark: SparkSession, landing: str, days: Days, cfg: EngineConfig,
                   archives: bool | None = None) -> DataFrame:
    """Arrival report of the days; raises when a day has no file of the format to be read."""
    report = slots.arrivals_per_day(
        slots.expected_slots(days_frame(spark, days), cfg),
        slots.landed_slots(spark, landing, cfg, days, archives))
    slots.require_arrivals(report)
    return report


def stored_days(spark: SparkSession, table, days: Days | None = None) -> set[dt.date]:
    """File dates, or months, that a table has a partition for. Metadata only."""
    key = F.col(table.partitioned_by[0])
    found = partition_values(spark, table)
    return {r[0] for r in (found if days is None else found.filter(days.contains(key))).collect()}


def require_every_day(found: Collection[dt.date], days: Days, layer: str) -> None:
    """Raise with every day of the range that is not found, as a run of that day would."""
    without = [d for d in days.each() if d not in set(found)]
    if without:
        raise quality.QualityError(f"{layer}: no rows for {', '.join(map(str, without))}", without)


def run_bronze(spark: SparkSession, lake: Lake, landing: str, days: Days, archives: bool = False,
               quote: str = "", ingested_at: dt.datetime | None = None,
               set_aside: bool = False) -> dict[str, int]:
    """Landed files -> bronze partitions of their file dates.

    A day without a line stops the load before anything is published; with ``set_aside``
    it loses the partition it may have, and the other days are loaded. The rows are counted
    while they are staged, so the report costs no further read.
    """
    check_arrivals(spark, landing, days, lake.cfg, archives)
    read = lines.read_archives if archives else lines.read_tsv
    rows = to_bronze(read(spark, landing, days, quote), ingested_at=ingested_at, diagnostics=True)
    metrics = quality.bronze_checks(rows.columns, days)
    metrics["file_dates"] = F.collect_set(quality.line_dates(rows.columns))
    with staged_and_counted(rows, "bronze", metrics) as (kept, found):
        dates = set(found.pop("file_dates"))  # one per day of the landing area
        found["extra_file_dates"] = max(0, len(dates) - 1)
        single = days.end - days.start == dt.timedelta(days=1)
        ignore = set() if single else {"extra_file_dates"}
        quality.enforce_counts(found, "bronze", ignore | ({"empty"} if set_aside else set()))
        loaded = kept.filter(F.col(schema.READ_ERROR).isNull()).select(*schema.BRONZE.names)
        quality.check_columns(loaded, schema.BRONZE, "bronze")
        if set_aside:
            drop_partitions(spark, lake.bronze, stored_days(spark, lake.bronze, days) - dates)
        else:
            require_every_day(dates, days, "bronze")
        if dates:
            publish_by_day(loaded, lake.bronze, dates)
    return found


def run_silver(spark: SparkSession, lake: Lake, days: Days, set_aside: bool = False) -> dict[str, int]:
    """Bronze partitions of the days -> all silver rows of those file dates. ``set_aside``
    as for bronze: days without an event lose their rows instead of stopping the load."""
    bronze = lake.bronze.read(spark).filter(days.contains(F.col("input_file_date")))
    rows = to_silver(bronze, lake.cfg)
    quality.check_columns(rows, schema.SILVER, "silver")
    with staged(rows, "silver") as kept:
        single = days.end - days.start == dt.timedelta(days=1)
        ignore = set() if single else {"extra_file_dates"}
        found, dates = quality.silver_counts(kept, days)
        quality.enforce_counts(found, "silver", ignore | ({"empty"} if set_aside else set()))
        if not set_aside:
            require_every_day(dates, days, "silver")
        publish_silver(kept, lake.silver, days, lake.cfg, lake.event_days, dates)
    return found


def due_frame(spark: SparkSession, due: dict[dt.date, bool]) -> DataFrame:
    """``year_month, require_full_month`` for the months to build."""
    rows = [F.struct(F.lit(m).alias("year_month"), F.lit(full).alias("require_full_month"))
            for m, full in sorted(due.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def eligible_months(silver: DataFrame, due: DataFrame) -> DataFrame:
    """Due months that have all their days, or need not have them."""
    complete = coverage.complete_months(silver).withColumn("is_complete", F.lit(True))
    return (due.join(complete, "year_month", "left")
            .filter(~F.col("require_full_month") | F.col("is_complete")).select("year_month"))


def index_for(silver: DataFrame, due: DataFrame, cfg: EngineConfig, as_of_month_end: bool,
              ingested_at: dt.datetime | None = None) -> DataFrame:
    """Index of all due months in one pass. ``as_of_month_end`` ignores files that
    came after a month's last day, as a run on that day would."""
    seen = gold_ops.as_of_month_end(silver) if as_of_month_end else silver
    wanted = gold_ops.for_months(seen, eligible_months(seen, due), "event_date")
    return gold_ops.monthly_index(wanted, cfg, ingested_at)


def run_gold(spark: SparkSession, lake: Lake, due: dict[dt.date, bool],
             as_of_month_end: bool = False, ingested_at: dt.datetime | None = None,
             may_be_empty: bool = False) -> list[dt.date]:
    """Silver -> index of the due months (month -> must it be complete?); returns the
    months built. Months that are not complete but must be are left as they are, and one
    that need not be must have events unless ``may_be_empty``.

    Gate and index open the file dates that have events of these months, and no others.
    """
    if not due:
        return []
    # As of a month's end no later file counts, so their directories are not opened.
    silver = silver_of_months(spark, lake, due, month_after(max(due)) if as_of_month_end else None)
    # Checked in 64 bits, so that an overflow is a finding and not a failed cast.
    wide = replace(lake.cfg, measure_type="bigint")
    rows = index_for(silver, due_frame(spark, due), wide, as_of_month_end, ingested_at)
    metrics = quality.gold_checks() | {"months": F.collect_set("year_month")}
    with staged_and_counted(rows, "gold", metrics) as (kept, found):
        built = set(found.pop("months"))
        # A month that is not complete is left alone; one that need not be must have rows.
        without = sorted(m for m, full in due.items() if not full and m not in built)
        if without and not may_be_empty:
            raise quality.QualityError(f"gold: no events in {', '.join(map(str, without))}", without)
        if not built:
            return []
        found["extra_months"] = len(built) - 1
        ignore = {"extra_months"} if len(due) > 1 else set()
        if lake.cfg.measure_type == "bigint":
            ignore.add("count_overflow")
        quality.enforce_counts(found, "gold", ignore)
        final = kept.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in lake.gold.schema])
        quality.check_columns(final, lake.gold.schema, "gold")
        publish(final, lake.gold)
    return sorted(built)
