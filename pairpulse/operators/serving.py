"""Read side of the index: readable names, pickers, series and detail of one pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse.config import EngineConfig

DETAIL_COLUMNS = ["year_month", "suri_score", "geo_unrest_score", "pol_involve_score",
                  "total_events"]


def country_dimension(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """Code and name of every focus country, built from literals in the JVM."""
    pairs = [F.struct(F.lit(c).alias("code"), F.lit(n).alias("name"))
             for c, n in cfg.country_names.items()]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def with_country_names(gold: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Add ``source_country`` and ``target_country``; an unmapped code gives NULL.

    The dimension is the configured list, at most 1,024 rows, hence the broadcast.
    """
    out = gold
    for code, name in (("Actor1CountryCode", "source_country"),
                       ("Actor2CountryCode", "target_country")):
        dim = country_dimension(gold.sparkSession, cfg).toDF(f"{name}_code", name)
        out = out.join(F.broadcast(dim), F.col(code) == F.col(f"{name}_code"), "left")
        out = out.drop(f"{name}_code")
    return out


def country_choices(named: DataFrame, side: str) -> DataFrame:
    """Distinct names of one side (``source`` or ``target``) in order, NULL last."""
    name = f"{side}_country"
    return (named.select(F.col(name).alias("country")).distinct()
            .orderBy(F.col("country").asc_nulls_last()))


def pair_codes(cfg: EngineConfig, source: str, target: str) -> dict[str, list[str]]:
    """The codes of one ordered pair of readable names, by column."""
    return {column: [c for c, n in cfg.country_names.items() if n == name]
            for column, name in (("Actor1CountryCode", source), ("Actor2CountryCode", target))}


def for_pair(rows: DataFrame, cfg: EngineConfig, source: str, target: str) -> DataFrame:
    """Rows of one ordered pair of readable names, by code: a filter that reaches the scan
    of silver or of the index, which are laid out by code."""
    for column, codes in pair_codes(cfg, source, target).items():
        rows = rows.filter(F.col(column).isin(codes))
    return rows


def select_pair(named: DataFrame, source: str, target: str) -> DataFrame:
    """Months of one ordered pair, oldest first."""
    return (named.filter((F.col("source_country") == source) & (F.col("target_country") == target))
            .orderBy("year_month"))


def pair_series(named: DataFrame, source: str, target: str) -> DataFrame:
    return select_pair(named, source, target).select("year_month", "suri_score")


def pair_detail(named: DataFrame, source: str, target: str) -> DataFrame:
    return select_pair(named, source, target).select(*DETAIL_COLUMNS)


def pair_message(series: DataFrame) -> str | None:
    """What to tell the reader when a pair has no data."""
    return "There are no months for this pair of countries." if series.isEmpty() else None
