"""Silver events -> monthly index per ordered country pair."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from pairpulse import schema
from pairpulse.config import EngineConfig
from pairpulse.functions.dates import month_of
from pairpulse.functions.flags import government_flows, is_unrest
from pairpulse.operators.bronze import load_time

PAIR_MONTH = ["year_month", "Actor1CountryCode", "Actor2CountryCode"]


def measures(cfg: EngineConfig) -> dict[str, Column]:
    """The aggregates of one pair and month, by output name."""
    kind = cfg.measure_type

    def whole(c: Column) -> Column:
        return c.cast(kind)

    out = {
        "total_events": whole(F.count(F.lit(1))),
        "geo_unrest_score": whole(F.count_if(is_unrest(cfg))),
    }
    out |= {name: whole(F.count_if(hit)) for name, hit in government_flows(cfg).items()}
    out |= {
        "avg_goldstein": F.avg("GoldsteinScale"),
        "total_mentions": whole(F.sum("NumMentions")),
        "total_sources": whole(F.sum("NumSources")),
        "total_articles": whole(F.sum("NumArticles")),
        "avg_tone": F.avg("AvgTone"),
    }
    return out


def pair_month_measures(silver: DataFrame, cfg: EngineConfig, *names: str) -> DataFrame:
    """Named measures (all by default) per month, source and target country.

    Partial aggregation leaves at most pairs x months rows per task for the shuffle.
    """
    chosen = measures(cfg)
    return (silver
            .groupBy(month_of(F.col("event_date")).alias("year_month"),
                     "Actor1CountryCode", "Actor2CountryCode")
            .agg(*[chosen[n].alias(n) for n in names or chosen]))


def with_involvement(pairs: DataFrame) -> DataFrame:
    """Share of events in one of the three government flows."""
    flows = (F.col("total_gov_gov_events") + F.col("total_ngov_gov_events")
             + F.col("total_gov_ngov_events"))
    return pairs.withColumn("pol_involve_score", flows / F.col("total_events"))


def with_index(pairs: DataFrame) -> DataFrame:
    """Unrest count weighted by political involvement."""
    return pairs.withColumn(
        "suri_score", F.col("geo_unrest_score") * F.col("pol_involve_score"))


def monthly_index(silver: DataFrame, cfg: EngineConfig,
                  ingested_at: dt.datetime | None = None) -> DataFrame:
    """The gold layer for every month present in ``silver``, in published column order."""
    scored = with_index(with_involvement(pair_month_measures(silver, cfg)))
    return (scored.withColumn("ingested_at", load_time(ingested_at))
            .select(*schema.GOLD.names))


def as_of_month_end(silver: DataFrame) -> DataFrame:
    """Only rows already loaded when their month ended: file date <= last day of month."""
    return silver.filter(F.col("input_file_date") <= F.last_day("event_date"))


def for_months(df: DataFrame, months: DataFrame, date: str) -> DataFrame:
    """Rows whose month is in ``months`` (one row per month: broadcast is bounded by
    the calendar, at most 120,000 rows for four-digit years)."""
    wanted = months.select(F.col("year_month").alias("wanted_month"))
    return df.join(F.broadcast(wanted), month_of(F.col(date)) == F.col("wanted_month"), "left_semi")
