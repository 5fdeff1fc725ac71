"""One function per query: ``(spark, folder of the test tables) -> DataFrame``.

All of them run over whole tables. Queries that publish tables write below the scratch
folder, in a lake of their own.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairpulse import schema
from pairpulse.catalogue import fixtures as fx
from pairpulse.config import EngineConfig
from pairpulse.functions.dates import Days
from pairpulse.functions.zorder import z_key
from pairpulse.operators import coverage, gold, quality, serving, silver
from pairpulse.operators.bronze import to_bronze
from pairpulse.plans import backfill, jobs
from pairpulse.sinks.extract import export_index_csv
from pairpulse.sinks.staging import new_scratch_path, staged
from pairpulse.sinks.tables import Lake, clustered, publish, publish_silver
from pairpulse.sources import landing, lines, slots
from pairpulse.sources.extract import read_index_csv
from pairpulse.sources.star_events import star_events
from pairpulse.streaming.incremental import load_landed

Query = Callable[[SparkSession, str], DataFrame]

CFG = EngineConfig()
GLOBAL = EngineConfig(dedup_scope="global")
NULL_IS_NONGOV = EngineConfig(null_type_is_nongov=True)
PAIR = ("United States", "China")
_LOADED = dt.datetime(2026, 1, 1)


def _silver(spark: SparkSession, sf_dir: str, *needed: str, cfg: EngineConfig = CFG,
            only: Mapping[str, Collection[str]] | None = None) -> DataFrame:
    """Silver with the needed columns, reading only what those depend on."""
    carried = silver.carried_columns(needed, cfg)
    read = {"Day", *cfg.essential_columns, *carried} - {"event_date", "ingested_at"}
    return silver.to_silver(star_events(spark, sf_dir, sorted(read)), cfg, needed, only)


def _index(spark: SparkSession, sf_dir: str, cfg: EngineConfig = CFG) -> DataFrame:
    return gold.monthly_index(_silver(spark, sf_dir, *fx.INDEX_COLUMNS, cfg=cfg), cfg)


def _pair_month(*names: str, cfg: EngineConfig = CFG) -> Query:
    """A query for some measures, carrying only the silver columns they read."""
    reads = {
        "geo_unrest_score": ["EventRootCode"],
        "total_gov_gov_events": ["Actor1Type1Code", "Actor2Type1Code"],
        "avg_goldstein": ["GoldsteinScale"], "avg_tone": ["AvgTone"],
        "total_mentions": ["NumMentions"], "total_sources": ["NumSources"],
        "total_articles": ["NumArticles"],
    }

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        needed = ["event_date", "Actor1CountryCode", "Actor2CountryCode"]
        needed += [c for n in names for c in reads.get(n, [])]
        return gold.pair_month_measures(_silver(spark, sf_dir, *needed, cfg=cfg), cfg, *names)

    return run


_FLOWS = ("total_gov_gov_events", "total_ngov_gov_events", "total_gov_ngov_events")


# --- silver ---------------------------------------------------------------------------

def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.to_silver(star_events(spark, sf_dir, fx.BRONZE_FOR_SILVER), CFG)


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.to_silver(star_events(spark, sf_dir, fx.BRONZE_FOR_SILVER), GLOBAL)


def event_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of the month is replaced by 0 to 39, so that many dates do not exist."""
    days = star_events(spark, sf_dir, ["GlobalEventID", "Day", "QuadClass", "GoldsteinScale"])
    planted = days.withColumn("Day", (
        F.floor(F.col("Day") / 100) * 100 + F.col("GoldsteinScale") * 2 + 20).cast("int"))
    return silver.parse_event_date(planted).select("GlobalEventID", "Day", "event_date")


def focus_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star_events(spark, sf_dir, ["GlobalEventID", "input_file_date", "Actor1CountryCode",
                                         "Actor2CountryCode"])
    return silver.focus_filter(events, CFG)


def essential_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star_events(spark, sf_dir, ["GlobalEventID", "Day", "input_file_date", "EventRootCode",
                                         "Actor1CountryCode", "Actor2CountryCode"])
    return silver.require_essentials(silver.parse_event_date(events), CFG)


def _before_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["GlobalEventID", "input_file_date", "Day", "Actor1CountryCode",
              "Actor2CountryCode", "EventRootCode"]
    return silver.clean_events(star_events(spark, sf_dir, needed), CFG)


def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.duplicate_ids(_before_dedup(spark, sf_dir), CFG)


def duplicates_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _before_dedup(spark, sf_dir)
    stages = {"before": before, "after": silver.dedup_events(before, CFG)}
    found = [silver.duplicate_exists(df, CFG).select(F.lit(name).alias("stage"), "has_duplicates")
             for name, df in stages.items()]
    return found[0].unionByName(found[1])


def silver_latest_file_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.latest_file_wins(silver_events(spark, sf_dir))


def z_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir, "event_date", "Actor1CountryCode", "Actor2CountryCode")
    pair = ["Actor1CountryCode", "Actor2CountryCode"]
    return (rows.groupBy(*pair).agg(F.count(F.lit(1)).alias("events"))
            .select(*pair, z_key(CFG).alias("z_key"), "events"))


# --- gold -----------------------------------------------------------------------------

def monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).select(*fx.GOLD_COLUMNS)


def monthly_index_null_nongov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir, NULL_IS_NONGOV).select(*fx.GOLD_COLUMNS)


def political_involvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.with_involvement(_pair_month("total_events", *_FLOWS)(spark, sf_dir))


def suri_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pair_month("total_events", "geo_unrest_score", *_FLOWS)(spark, sf_dir)
    return gold.with_index(gold.with_involvement(pairs)).select(
        *gold.PAIR_MONTH, "geo_unrest_score", "pol_involve_score", "suri_score")


def monthly_index_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir, *fx.INDEX_COLUMNS)
    full = gold.for_months(rows, coverage.complete_months(rows), "event_date")
    return gold.monthly_index(full, CFG).select(*fx.GOLD_COLUMNS)


# --- coverage and plans ---------------------------------------------------------------

def month_event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.event_dates(_silver(spark, sf_dir, "event_date"))


def month_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing_days(_silver(spark, sf_dir, "event_date"))


def month_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.month_completeness(_silver(spark, sf_dir, "event_date"))


def affected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.affected_months(_silver(spark, sf_dir, "input_file_date", "event_date"))


def _file_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last file; a day without a file is skipped."""
    files = star_events(spark, sf_dir, ["input_file_date"]).distinct()
    return (coverage.calendar_of(files, "input_file_date")
            .join(files.withColumn("seen", F.lit(True)), F.col("day") == F.col("input_file_date"), "left")
            .select(F.col("day").alias("file_date"), F.col("seen").isNull().alias("is_skipped")))


def backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.with_plan(_file_days(spark, sf_dir))


def backfill_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir, *fx.INDEX_COLUMNS, "input_file_date")
    due = backfill.due_months(backfill_plan(spark, sf_dir))
    return jobs.index_for(rows, due, CFG, as_of_month_end=True).select(*fx.GOLD_COLUMNS)


# --- slots and raw lines --------------------------------------------------------------

def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot has arrived when the quarter of an hour numbered id % 96 has an event."""
    rows = star_events(spark, sf_dir, ["GlobalEventID", "input_file_date"])
    stamp = F.timestamp_add("MINUTE", (F.col("GlobalEventID") % 96 * 15).cast("int"),
                            F.col("input_file_date").cast("timestamp_ntz"))
    return rows.select(F.col("input_file_date").alias("file_date"),
                       slots.slot_name(CFG, stamp).alias("slot")).distinct()


def file_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = coverage.calendar_of(star_events(spark, sf_dir, ["input_file_date"]), "input_file_date")
    return slots.expected_slots(days, CFG)


def missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.missing_slots(file_slots(spark, sf_dir), _arrived(spark, sf_dir))


def slot_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.arrivals_per_day(file_slots(spark, sf_dir), _arrived(spark, sf_dir))


_ROUNDTRIP = ["GlobalEventID", "Day", "FractionDate", "Actor1Name", "Actor1CountryCode",
              "Actor2CountryCode", "Actor2Type1Code", "GoldsteinScale", "AvgTone", "ActionGeo_Long",
              "DATEADDED", "SOURCEURL", "input_file_date", schema.MALFORMED]


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines are kept as gzip, which the reader inflates: as plain text they are the largest
    thing on the disks."""
    landing = fx.write_landing(fx.event_lines(spark, sf_dir, planted=True, by_slot=True),
                               new_scratch_path(spark, "landing"), compression="gzip")
    return to_bronze(lines.read_tsv(spark, landing), diagnostics=True).select(*_ROUNDTRIP)


def damaged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all archives but those of the 13th of a month, in which a byte has flipped."""
    archives = fx.damage_archives(fx.pack_archives(fx.event_lines(spark, sf_dir, planted=True, by_slot=True)))
    rows = to_bronze(lines.unpack_archives(archives), diagnostics=True)
    return rows.filter(F.col(schema.READ_ERROR).isNull()).select(*_ROUNDTRIP)


def zip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = fx.pack_archives(fx.event_lines(spark, sf_dir, planted=True, by_slot=True))
    return to_bronze(lines.unpack_archives(archives), diagnostics=True).select(*_ROUNDTRIP)


def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive files of all days but the first of a month; those that cannot be read give
    their date and the reason, once for each day."""
    lines_of = fx.event_lines(spark, sf_dir, planted=True, by_slot=True)
    folder = fx.write_archives(fx.pack_archives(lines_of), new_scratch_path(spark, "archives"))
    lo, _, end = _file_range(star_events(spark, sf_dir, ["input_file_date"]))
    days = Days(lo, end).without([d for d in Days(lo, end).each() if d.day == 1])
    raw = lines.read_archives(spark, folder, days, max_bytes=fx.LARGEST_ARCHIVE)
    rows = to_bronze(raw, diagnostics=True)
    reason = F.col(schema.READ_ERROR)
    known = F.when(reason.isin(lines.TOO_LARGE.format(fx.LARGEST_ARCHIVE), lines.NO_MEMBER), reason).otherwise("damaged")
    failed = rows.filter(reason.isNotNull()).select("input_file_date", known.alias(schema.READ_ERROR)).distinct()
    good = rows.filter(reason.isNull()).select(*_ROUNDTRIP, schema.READ_ERROR)
    return good.unionByName(failed, allowMissingColumns=True)


def landing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of the landing area that a load reads, and names that none does. Only its listing
    is read, so its lines are kept compressed."""
    path = fx.write_landing(fx.stray_names(fx.event_lines(spark, sf_dir, by_slot=True)),
                            new_scratch_path(spark, "landing"), compression="gzip")
    name = F.regexp_extract("path", "slot=([^/]*)", 1)

    def names(files: DataFrame, kind: str) -> DataFrame:
        return files.agg(F.lit(kind).alias("kind"), F.count_distinct(name).alias("names"))

    return (names(landing.landing_strays(spark, path), "stray")
            .unionByName(slots.landed_slots(spark, path, CFG).agg(
                F.lit("slot").alias("kind"), F.count_distinct("slot").alias("names"))))


_CAST = ["Day", "NumMentions", "NumSources", "GoldsteinScale", "AvgTone", "Actor1Geo_Lat",
         "FractionDate", "QuadClass", "SOURCEURL", "input_file_date"]


def bronze_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(fx.planted_raw(spark, sf_dir)).select("GlobalEventID", *_CAST)


# --- reports --------------------------------------------------------------------------

def quality_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.planted_faults(fx.planted_raw(spark, sf_dir))
    return quality.bronze_report(to_bronze(raw, diagnostics=True))


def quality_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On rows before deduplication, so that there is something to find."""
    return quality.silver_report(_before_dedup(spark, sf_dir))


def quality_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gold_report(_index(spark, sf_dir))


def quality_gold_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gold_report(fx.planted_gold(_index(spark, sf_dir)))


# --- published tables -----------------------------------------------------------------

def _new_lake(spark: SparkSession) -> Lake:
    lake = Lake(prefix=f"replay_{uuid.uuid4().hex[:12]}_")
    lake.create(spark, new_scratch_path(spark, "lake"))
    return lake


def _file_range(events: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    """First day, a day in the middle, day after the last."""
    lo, hi = events.agg(F.min("input_file_date"), F.max("input_file_date")).first()
    return lo, lo + (hi - lo) / 2, hi + dt.timedelta(days=1)


def _overlapping(events: DataFrame) -> list[Days]:
    """Two ranges that cover all days and share 180 of them."""
    lo, mid, end = _file_range(events)
    shared = dt.timedelta(days=90)
    return [Days(lo, mid + shared), Days(mid - shared, end)]


def bronze_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _new_lake(spark)
    events = star_events(spark, sf_dir).withColumn("ingested_at", F.lit(_LOADED).cast("timestamp"))
    with staged(events, "bronze_replay") as rows:
        for days in _overlapping(rows):
            publish(rows.filter(days.contains(F.col("input_file_date"))), lake.bronze)
    return lake.bronze.read(spark).drop("ingested_at")


def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ranges go in with their events a day early, then as they should be. Only the
    second version may remain."""
    lake = _new_lake(spark)
    bronze = star_events(spark, sf_dir, fx.BRONZE_FOR_SILVER)
    right = silver.to_silver(bronze, CFG).withColumn("ingested_at", F.lit(_LOADED).cast("timestamp"))
    with staged(right, "silver_replay") as rows:
        wrong = rows.withColumn("event_date", F.date_sub("event_date", 1))
        for version in (wrong, rows):
            for days in _overlapping(rows):
                publish_silver(version.filter(days.contains(F.col("input_file_date"))), lake.silver, days, CFG)
    return lake.silver.read(spark).drop("ingested_at")


def gold_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months are published empty-handed first, then with their values."""
    lake = _new_lake(spark)
    with staged(_index(spark, sf_dir), "gold_replay") as rows:
        publish(rows.withColumn("suri_score", F.lit(-1.0)), lake.gold)
        publish(rows, lake.gold)
    return lake.gold.read(spark).select(*fx.GOLD_COLUMNS)


def _stored_silver(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with all of silver and its event days."""
    lake = _new_lake(spark)
    bronze = star_events(spark, sf_dir, fx.BRONZE_FOR_SILVER)
    with staged(silver.to_silver(bronze, CFG).withColumn("ingested_at", F.lit(_LOADED).cast("timestamp")),
                "stored_silver") as rows:
        lo, _, end = _file_range(rows)
        publish_silver(rows, lake.silver, Days(lo, end), CFG, lake.event_days)
    return lake


def gold_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index from stored silver, every other month at a time, each opening the file
    dates of its months only; and how many those are."""
    lake = _stored_silver(spark, sf_dir)
    days = coverage.affected_months(lake.event_days.read(spark))
    months = sorted(r.year_month for r in days.select("year_month").distinct().collect())  # the calendar's
    for turn in (months[::2], months[1::2]):
        jobs.run_gold(spark, lake, dict.fromkeys(turn, False))
    opened = days.groupBy("year_month").agg(F.count("input_file_date").alias("file_dates"))
    return lake.gold.read(spark).join(opened, "year_month").select(*fx.GOLD_COLUMNS, "file_dates")


def layout_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written in its clustered order, in files of a 64th of its rows, and for each
    country on either side whether the files that hold it are as few as the order promises.

    Rows of a country stand in runs of the interleaved key. A run of r rows touches r / size
    full files, two more at its ends, and files that are short because a task ended there.
    """
    rows = _silver(spark, sf_dir, "event_date", "Actor1CountryCode", "Actor2CountryCode", "GlobalEventID")
    path = new_scratch_path(spark, "layout")
    with staged(rows, "layout") as kept:
        size = max(1, -(-kept.count() // 64))
        clustered(kept, CFG, []).write.option("maxRecordsPerFile", size).parquet(path)
    stored = spark.read.parquet(path).withColumns({"file": F.col("_metadata.file_path"), "z": z_key(CFG)})
    short = stored.groupBy("file").count().agg(F.count_if(F.col("count") < size).alias("short"))
    keys = (stored.groupBy("z", "Actor1CountryCode", "Actor2CountryCode").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("place", F.row_number().over(Window.orderBy("z"))))  # a row per pair of countries

    def side(name: str, code: str) -> DataFrame:
        own = Window.partitionBy(code).orderBy("z")
        runs = (keys.withColumn("run", F.col("place") - F.row_number().over(own)).groupBy(code, "run")
                .agg(F.sum("n").alias("n")).groupBy(code)
                .agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("z_runs"),
                     F.sum(F.floor(F.col("n") / size) + 2).alias("most")))
        opened = stored.groupBy(code).agg(F.count_distinct("file").alias("files"))
        return (runs.join(opened, code).crossJoin(short)
                .select(F.lit(name).alias("side"), F.col(code).alias("country"), "events", "z_runs",
                        (F.col("files") <= F.col("most") + F.col("short")).alias("within_bound")))

    return side("source", "Actor1CountryCode").unionByName(side("target", "Actor2CountryCode"))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, Days]:
    """Every event as landed files, kept as gzip, and the days that have one."""
    events = star_events(spark, sf_dir, ["input_file_date"]).filter("input_file_date IS NOT NULL")
    days = Days.of([r[0] for r in events.distinct().collect()])  # one row per day of the landing area
    landed = fx.write_landing(fx.event_lines(spark, sf_dir, by_slot=True), new_scratch_path(spark, "landing"),
                              compression="gzip")
    return landed, days


def _backfilled(spark: SparkSession, lake: Lake, path: str, days: Days) -> None:
    """A backfill that stops at days without an event, and goes through when they are skipped."""
    try:
        backfill.run_backfill(spark, lake, path, days.start, days.end, days.skip)
    except quality.QualityError as stopped:
        if not stopped.days:
            raise
        backfill.run_backfill(spark, lake, path, days.start, days.end, days.without(stopped.days).skip)


def backfill_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to published index through all three jobs."""
    lake = _new_lake(spark)
    _backfilled(spark, lake, *_landed(spark, sf_dir))
    return lake.gold.read(spark).select(*fx.GOLD_COLUMNS)


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days up to the last ten of the month before the last in one go, then a daily run for
    each of the days after them, so two months end in daily runs. A day without an event fails
    and is left behind, as a scheduler would leave it."""
    lake = _new_lake(spark)
    path, days = _landed(spark, sf_dir)
    last = days.end - dt.timedelta(days=1)
    first = last.replace(day=1) - dt.timedelta(days=10)
    if days.start < first:
        _backfilled(spark, lake, path, Days(days.start, first, days.skip))
    by_day = path + "/slot={day}*"
    for day in Days(max(first, days.start), days.end).each():
        try:
            backfill.run_daily(spark, lake, by_day, day)
        except (slots.NoInputError, quality.QualityError) as stopped:
            if stopped.days != [day] and "empty=1" not in str(stopped):
                raise
    return lake.gold.read(spark).select(*fx.GOLD_COLUMNS)


def _streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """The landed files in two batches, however many files a day has: each batch brings the
    index of its months up to date from all that is loaded."""
    lake = _new_lake(spark)
    path, _ = _landed(spark, sf_dir)
    files = landing.landed_files(spark, path).count()
    batches = load_landed(spark, lake, path, new_scratch_path(spark, "stream"),
                          files_per_batch=max(1, -(-files // 2)))
    batches.awaitTermination()
    return lake


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to published silver through the stream."""
    return _streamed(spark, sf_dir).silver.read(spark).drop("ingested_at")


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to the published index through the stream."""
    return _streamed(spark, sf_dir).gold.read(spark).select(*fx.GOLD_COLUMNS)


# --- serving --------------------------------------------------------------------------

def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a map that lacks one code that occurs."""
    short = replace(CFG, country_names={c: n for c, n in CFG.country_names.items() if c != "TWN"})
    return serving.with_country_names(_index(spark, sf_dir), short).select(
        "year_month", "Actor1CountryCode", "Actor2CountryCode", "source_country",
        "target_country", "suri_score")


def country_pickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _silver(spark, sf_dir, "Actor1CountryCode", "Actor2CountryCode").distinct()
    named = serving.with_country_names(codes, CFG)
    return (serving.country_choices(named, "source").withColumn("side", F.lit("source"))
            .union(serving.country_choices(named, "target").withColumn("side", F.lit("target"))))


def _pair_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of one pair: only its events go through deduplication as wide rows."""
    rows = _silver(spark, sf_dir, *fx.INDEX_COLUMNS, only=serving.pair_codes(CFG, *PAIR))
    return serving.with_country_names(gold.monthly_index(rows, CFG), CFG)


def pair_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.pair_series(_pair_named(spark, sf_dir), *PAIR)


def pair_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.pair_detail(_pair_named(spark, sf_dir), *PAIR)


def gold_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export_index_csv(_index(spark, sf_dir), new_scratch_path(spark, "extract"), _LOADED.date())
    return read_index_csv(spark, path).select(*fx.GOLD_COLUMNS)


QUERIES: dict[str, Query] = {
    "monthly_index": monthly_index,
    "silver_events": silver_events,
    "event_date_parse": event_date_parse,
    "focus_filter": focus_filter,
    "essential_not_null": essential_not_null,
    "dedup_events": dedup_events,
    "duplicate_ids": duplicate_ids,
    "duplicates_exist": duplicates_exist,
    "unrest_counts": _pair_month("total_events", "geo_unrest_score"),
    "gov_flow_counts": _pair_month(*_FLOWS),
    "gov_flow_counts_null_nongov": _pair_month(*_FLOWS, cfg=NULL_IS_NONGOV),
    "coverage_totals": _pair_month("total_mentions", "total_sources", "total_articles"),
    "tone_goldstein_avg": _pair_month("avg_goldstein", "avg_tone"),
    "political_involvement": political_involvement,
    "suri_score": suri_score,
    "monthly_index_null_nongov": monthly_index_null_nongov,
    "month_event_dates": month_event_dates,
    "month_missing_days": month_missing_days,
    "month_completeness": month_completeness,
    "monthly_index_gated": monthly_index_gated,
    "file_slots": file_slots,
    "missing_slots": missing_slots,
    "slot_arrivals": slot_arrivals,
    "tsv_roundtrip": tsv_roundtrip,
    "zip_roundtrip": zip_roundtrip,
    "damaged_archives": damaged_archives,
    "archive_files": archive_files,
    "landing_strays": landing_names,
    "bronze_cast": bronze_cast,
    "bronze_replay": bronze_replay,
    "silver_latest_file_wins": silver_latest_file_wins,
    "silver_replay": silver_replay,
    "gold_replay": gold_replay,
    "z_key": z_keys,
    "quality_bronze": quality_bronze,
    "quality_silver": quality_silver,
    "quality_gold": quality_gold,
    "quality_gold_planted": quality_gold_planted,
    "backfill_plan": backfill_plan,
    "backfill_gold": backfill_gold,
    "backfill_tables": backfill_tables,
    "daily_run": daily_run,
    "gold_pruned": gold_pruned,
    "layout_skipping": layout_skipping,
    "stream_silver": stream_silver,
    "stream_gold": stream_gold,
    "affected_months": affected_months,
    "country_names": country_names,
    "country_pickers": country_pickers,
    "pair_series": pair_series,
    "pair_detail": pair_detail,
    "gold_csv_roundtrip": gold_csv_roundtrip,
}
