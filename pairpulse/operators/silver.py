"""Bronze rows -> clean events between focus countries, one row per id."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from pairpulse import schema
from pairpulse.config import EngineConfig
from pairpulse.functions.dates import event_date

# Order in which copies of an event are compared. The first copy is kept. Every
# column takes part, so that the choice depends on the rows only.
_COMPARED_FIRST = [
    "input_file_date", "event_date", "Actor1CountryCode", "Actor2CountryCode",
    "Actor1Type1Code", "Actor2Type1Code", "EventRootCode", "GoldsteinScale",
    "NumMentions", "NumSources", "NumArticles", "AvgTone",
]


def tie_break_order(columns: list[str]) -> list[str]:
    first = [c for c in _COMPARED_FIRST if c in columns]
    return first + [c for c in columns if c not in first]


def parse_event_date(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_date", event_date(F.col("Day")))


def focus_filter(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Both sides must be focus countries; a missing code is not one."""
    codes = cfg.focus_countries
    return events.filter(
        F.col("Actor1CountryCode").isin(codes) & F.col("Actor2CountryCode").isin(codes))


def require_essentials(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Drop rows with a NULL in an essential column. One conjunct per column, which
    Catalyst can push to the scan each column comes from; ``dropna`` is a single
    predicate over all of them."""
    return events.filter(reduce(and_, [F.col(c).isNotNull() for c in cfg.essential_columns]))


def dedup_key(cfg: EngineConfig) -> list[str]:
    return ["GlobalEventID"] if cfg.dedup_scope == "global" else ["input_file_date", "GlobalEventID"]


def dedup_events(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Keep the least row per key, NULLs first; rows without an id form one group.

    ``min`` over a struct combines on the map side, so an id (or the NULL id) that
    holds a large share of all rows reaches the shuffle as one row per task. A window
    would bring all its copies together.
    """
    key = dedup_key(cfg)
    rest = tie_break_order([c for c in events.columns if c not in key])
    if not rest:
        return events.distinct()
    kept = events.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept"))
    out = [F.col(c) if c in key else F.col(f"kept.{c}").alias(c) for c in events.columns]
    return kept.select(*out)


def carried_columns(needed: Collection[str], cfg: EngineConfig) -> list[str]:
    """The silver columns deduplication must carry to get ``needed`` right.

    Copies are compared column by column, so the values of the first n columns of the
    kept copy do not depend on the columns after them: the shortest prefix of the
    comparison order that covers ``needed`` is enough.
    """
    key = dedup_key(cfg)
    order = [c for c in tie_break_order(schema.SILVER.names) if c not in key]
    last = max((order.index(c) for c in needed if c not in key), default=-1)
    return key + order[:last + 1]


def clean_events(bronze: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Silver rows before deduplication, with the silver columns ``bronze`` has."""
    events = parse_event_date(bronze)
    columns = [c for c in schema.SILVER.names if c in events.columns]
    return require_essentials(focus_filter(events.select(*columns), cfg), cfg)


def dedup_matching(events: DataFrame, only: Mapping[str, Collection[str]], cfg: EngineConfig) -> DataFrame:
    """The rows that ``dedup_events`` keeps and whose columns have one of the given values.

    A match may lose to a copy that is none, so all copies have to meet, but with no more
    than the leading columns that are compared. The other columns travel with matches only:
    one scan and one shuffle, whose wide part is as small as the answer. Where the least of
    the leading columns is a match, the least match is the least copy.
    """
    key = dedup_key(cfg)
    rest = tie_break_order([c for c in events.columns if c not in key])
    leading = rest[:max(rest.index(c) for c in only) + 1]

    def matches(prefix: str) -> Column:
        return reduce(and_, [F.col(prefix + c).isin(list(values)) for c, values in only.items()])

    kept = (events.groupBy(*key)
            .agg(F.min(F.struct(*leading)).alias("first"), F.min(F.when(matches(""), F.struct(*rest))).alias("kept"))
            .filter(matches("first.")))
    return kept.select(*[F.col(c) if c in key else F.col(f"kept.{c}").alias(c) for c in events.columns])


def to_silver(bronze: DataFrame, cfg: EngineConfig, needed: Collection[str] | None = None,
              only: Mapping[str, Collection[str]] | None = None) -> DataFrame:
    """The layer, whole or reduced to the ``needed`` columns and to rows with ``only`` these
    values. Filters run before the only shuffle, and only columns that matter go through it."""
    events = clean_events(bronze, cfg)
    if needed is not None:
        events = events.select(*carried_columns({*needed, *(only or ())}, cfg))
    kept = dedup_matching(events, only, cfg) if only else dedup_events(events, cfg)
    return kept if needed is None else kept.select(*needed)


def duplicate_ids(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Keys held by more than one row, with the number of copies."""
    return (events.groupBy(*dedup_key(cfg)).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def duplicate_exists(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row, ``has_duplicates``: whether any key is held by more than one row."""
    return duplicate_ids(events, cfg).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_duplicates"))


def latest_file_wins(silver: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Per event date only the rows of the last file date that touched it.

    This is what remains when every file date overwrites whole event dates. The right side
    has one row of two dates per calendar day that occurs, at most 3.3 million for years of
    four digits, or 30 MB: it is broadcast, which spares the wide rows a second shuffle. A
    window over event dates would gather a hot date in one task.

    ``dates`` has the two dates of the same rows: of stored silver give the table of event
    days, which loads keep up to date. Without it they come from ``silver`` itself, whose
    shuffle both sides of the join share: what is computed once is wide, and nothing twice.
    """
    # A row without a file date is never the last; said for both sides, so that they stay alike.
    silver = silver.filter(F.col("input_file_date").isNotNull())
    latest = ((silver if dates is None else dates).groupBy(F.col("event_date").alias("d"))
              .agg(F.max("input_file_date").alias("last")))
    return silver.join(
        F.broadcast(latest),
        (F.col("event_date") == F.col("d")) & (F.col("input_file_date") == F.col("last")),
        "left_semi")
