"""Which days and months the data covers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse.functions.dates import days_in_month, month_of


def event_dates(silver: DataFrame) -> DataFrame:
    """Distinct event dates with their month. Of the stored table this reads one column."""
    return (silver.select("event_date").distinct()
            .select(month_of(F.col("event_date")).alias("year_month"), "event_date"))


def event_days(silver: DataFrame) -> DataFrame:
    """Events by file date and event date."""
    return silver.groupBy("input_file_date", "event_date").agg(F.count(F.lit(1)).alias("events"))


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Days ``start <= day < end``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.date_sub(F.lit(end), 1))).alias("day"))


def calendar_of(df: DataFrame, date: str) -> DataFrame:
    """Every day between the first and the last ``date`` in the data."""
    return (df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
            .filter(F.col("lo").isNotNull())
            .select(F.explode(F.sequence("lo", "hi")).alias("day")))


def missing_days(silver: DataFrame) -> DataFrame:
    """Days without an event, in the months from the first to the last that has one."""
    dates = event_dates(silver)
    days = (dates.agg(F.min("year_month").alias("lo"), F.last_day(F.max("event_date")).alias("hi"))
            .filter(F.col("lo").isNotNull())
            .select(F.explode(F.sequence("lo", "hi")).alias("missing_date")))
    return (days.join(dates, F.col("missing_date") == F.col("event_date"), "left_anti")
            .select(month_of(F.col("missing_date")).alias("year_month"), "missing_date"))


def month_completeness(silver: DataFrame) -> DataFrame:
    """Per month with any event: days with events, days of the month, complete or not."""
    counted = (event_dates(silver).groupBy("year_month")
               .agg(F.count("event_date").alias("days_present")))
    total = days_in_month(F.col("year_month"))
    return counted.select(
        "year_month", "days_present", total.alias("days_in_month"),
        (F.col("days_present") == total).alias("is_complete"))


def complete_months(silver: DataFrame) -> DataFrame:
    return month_completeness(silver).filter("is_complete").select("year_month")


def affected_months(silver: DataFrame) -> DataFrame:
    """Months that each file date has events for."""
    return silver.select(
        "input_file_date", month_of(F.col("event_date")).alias("year_month")).distinct()
