"""Daily run, whole-range backfill and late-data refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairpulse.config import HISTORY_START, outage_days
from pairpulse.functions.dates import Days, is_month_end, month_of
from pairpulse.operators import coverage
from pairpulse.plans.jobs import run_bronze, run_gold, run_silver
from pairpulse.sinks.tables import Lake, stored_event_days


def with_plan(days: DataFrame) -> DataFrame:
    """Add to ``file_date, is_skipped`` what a day-by-day run would do on each day.

    A skipped day lifts the completeness requirement for the rest of its month; the
    index is due on the last day of every month, skipped or not. The window spans one
    calendar month, at most 31 rows.
    """
    so_far = (Window.partitionBy(month_of(F.col("file_date"))).orderBy("file_date")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.select(
        "file_date", "is_skipped",
        (~F.col("is_skipped")).alias("ingest"),
        (~F.bool_or("is_skipped").over(so_far)).alias("require_full_month"),
        is_month_end(F.col("file_date")).alias("run_gold"))


def backfill_plan(spark: SparkSession, start: dt.date = HISTORY_START,
                  end: dt.date | None = None,
                  skip: Collection[dt.date] | None = None) -> DataFrame:
    """Plan for ``start <= file date < end``; by default up to, not including, yesterday."""
    end = end or dt.date.today() - dt.timedelta(days=1)
    skip = outage_days() if skip is None else skip
    loaded = Days(start, end, frozenset(skip)).contains(F.col("day"))
    return with_plan(coverage.calendar(spark, start, end).select(
        F.col("day").alias("file_date"), (~loaded).alias("is_skipped")))


def due_months(plan: DataFrame) -> DataFrame:
    """Months whose last day is in the plan."""
    return plan.filter("run_gold").select(
        month_of(F.col("file_date")).alias("year_month"), "require_full_month")


def run_backfill(spark: SparkSession, lake: Lake, landing: str, start: dt.date, end: dt.date,
                 skip: Collection[dt.date] = (), archives: bool = False,
                 as_of_month_end: bool = True,
                 ingested_at: dt.datetime | None = None) -> list[dt.date]:
    """The whole range in three jobs; equals the daily runs one after the other."""
    days = Days(start, end, frozenset(skip))
    run_bronze(spark, lake, landing, days, archives=archives, ingested_at=ingested_at)
    run_silver(spark, lake, days)
    due = {r.year_month: r.require_full_month
           for r in due_months(backfill_plan(spark, start, end, skip)).collect()}
    return run_gold(spark, lake, due, as_of_month_end=as_of_month_end, ingested_at=ingested_at)


def run_daily(spark: SparkSession, lake: Lake, landing: str, day: dt.date | None = None,
              archives: bool = False, ingested_at: dt.datetime | None = None) -> list[dt.date]:
    """One day (yesterday by default); the index of its month when the month ends."""
    day = day or dt.date.today() - dt.timedelta(days=1)
    run_bronze(spark, lake, landing, Days.one(day), archives=archives, ingested_at=ingested_at)
    run_silver(spark, lake, Days.one(day))
    if (day + dt.timedelta(days=1)).day != 1:
        return []
    return run_gold(spark, lake, {day.replace(day=1): True}, ingested_at=ingested_at)


def run_refresh(spark: SparkSession, lake: Lake, days: Days,
                ingested_at: dt.datetime | None = None) -> list[dt.date]:
    """Rebuild the index of every published month that the given file dates touch, so
    that events that came late are counted."""
    touched = coverage.affected_months(stored_event_days(spark, lake, days)).select("year_month").distinct()
    published = lake.gold.read(spark).select("year_month").distinct()
    due = {r.year_month: False
           for r in touched.join(published, "year_month", "left_semi").collect()}
    return run_gold(spark, lake, due, ingested_at=ingested_at)
