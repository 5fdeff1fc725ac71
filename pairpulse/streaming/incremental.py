"""A file-source stream that brings all layers up to date with the landing area.

The stream watches the listing only. Each micro-batch names the file dates it touches
and the batch jobs rebuild exactly those dates, so there is no stream state, and
deduplication keeps its file-date scope even when a batch holds part of a day. Then the
index is brought to what the loaded files give, for the months that may have changed.

A ledger has a row for each batch. It is written before the tables are, with the months
whose events the batch may remove, and again when all is published: a batch that is
repeated after a failure refreshes those months too, and one that was done is passed over.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Collection

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pairpulse.functions.dates import Days, file_date, month_after
from pairpulse.operators import coverage
from pairpulse.plans.jobs import run_bronze, run_gold, run_silver, stored_days
from pairpulse.sinks.tables import Lake, drop_partitions, publish, stored_event_days
from pairpulse.sources.landing import paths_of

STARTED, DONE = "started", "done"
_LISTING = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def landed_dates(spark: SparkSession, landing: str, files_per_batch: int) -> DataFrame:
    """File dates of newly landed files. ``content`` is not selected and not read."""
    files = (spark.readStream.format("binaryFile").schema(_LISTING)
             .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
             .load(paths_of(spark, landing, None)[0]))
    return files.select(file_date(F.col("path")).alias("file_date"))


def stream_name(checkpoint: str) -> str:
    """What the ledger calls the stream of a checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def ledger_row(spark: SparkSession, lake: Lake, stream: str, batch_id: int) -> Row | None:
    rows = lake.stream_batches.read(spark).filter(
        (F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    return rows.first()


def _record(spark: SparkSession, lake: Lake, stream: str, batch_id: int, state: str,
            file_dates: Collection[dt.date], months: Collection[dt.date],
            set_aside: Collection[dt.date] = (), built: Collection[dt.date] = ()) -> None:
    row = (state, sorted(file_dates), sorted(set_aside), sorted(months), sorted(built), stream, batch_id)
    publish(spark.createDataFrame([row], lake.stream_batches.schema), lake.stream_batches)


def _span(first: dt.date, last: dt.date) -> set[dt.date]:
    """Months from that of one day to that of another."""
    month, out = first.replace(day=1), set()
    while month <= last:
        out.add(month)
        month = month_after(month)
    return out


def _months_of(spark: SparkSession, lake: Lake, days: Days) -> set[dt.date]:
    """Months that the stored file dates of these days have events for."""
    stored = stored_event_days(spark, lake, days)
    return {r.year_month for r in coverage.affected_months(stored).select("year_month").distinct().collect()}


def _months_at_risk(spark: SparkSession, lake: Lake, touched: Collection[dt.date]) -> set[dt.date]:
    """Months whose index may change when these file dates are loaded, whatever is in the
    files, apart from those of their new events: months that lose events, months of the
    file dates, and those that the first or the last loaded file date passes."""
    loaded = stored_days(spark, lake.bronze)
    first, last = min(touched), max(touched)
    out = _months_of(spark, lake, Days.of(touched)) | {d.replace(day=1) for d in touched}
    if not loaded:
        return out | _span(first, last)
    if first < min(loaded):
        out |= _span(first, min(loaded))
    if last > max(loaded):
        out |= _span(max(loaded), last)
    return out


def due_now(loaded: Collection[dt.date], months: Collection[dt.date]) -> dict[dt.date, bool]:
    """Which of the months a run over the loaded file dates, one after the other, would
    build: those whose last day it passes, complete ones only unless a day had no file."""
    if not loaded:
        return {}
    have, first, last = set(loaded), min(loaded), max(loaded)
    due = {}
    for month in sorted(months):
        end = month_after(month) - dt.timedelta(days=1)
        if first <= end <= last:
            start = max(month, first)
            every = {start + dt.timedelta(days=i) for i in range((end - start).days + 1)}
            due[month] = every <= have
    return due


def refresh_index(spark: SparkSession, lake: Lake, months: Collection[dt.date]) -> list[dt.date]:
    """Bring the index of these months to what all loaded files give; returns those built.
    A month that is not due, or not complete though it has to be, has no index."""
    due = due_now(stored_days(spark, lake.bronze), months)
    built = run_gold(spark, lake, due, may_be_empty=True)
    drop_partitions(spark, lake.gold, (set(months) - set(built)) & stored_days(spark, lake.gold))
    return built


def load_batch(spark: SparkSession, lake: Lake, landing: str, stream: str, batch_id: int,
               touched: Collection[dt.date], archives: bool = False) -> None:
    """One batch of a stream: its file dates through all layers, once, however often it is called."""
    before = ledger_row(spark, lake, stream, batch_id)
    if before and before.state == DONE:
        return
    months = _months_at_risk(spark, lake, touched) | set(before.months if before else ())
    _record(spark, lake, stream, batch_id, STARTED, touched, months)
    days = Days.of(touched)
    run_bronze(spark, lake, landing, days, archives=archives, set_aside=True)
    run_silver(spark, lake, days, set_aside=True)
    months |= _months_of(spark, lake, days)
    built = refresh_index(spark, lake, months)
    _record(spark, lake, stream, batch_id, DONE, touched, months,
            set(touched) - stored_days(spark, lake.silver, days), built)


def load_landed(spark: SparkSession, lake: Lake, landing: str, checkpoint: str,
                archives: bool = False, files_per_batch: int = 100_000) -> StreamingQuery:
    """Bring bronze, silver and the index up to date with the landing area, then stop.

    The index counts all files that have landed. A day without an event is set aside, noted
    in the ledger, and does not hold up the days after it.
    """
    name = stream_name(checkpoint)

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        # One row per calendar day of the batch.
        touched = [r.file_date for r in batch.filter("file_date IS NOT NULL").distinct().collect()]
        if touched:
            load_batch(spark, lake, landing, name, batch_id, touched, archives)

    return (landed_dates(spark, landing, files_per_batch).writeStream
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(rebuild).start())
