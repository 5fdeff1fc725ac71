"""Table definitions and idempotent publication.

* bronze: partitioned by file date; a load replaces the partitions it has rows for;
* silver: partitioned by file date, event date leading the order of its rows; a load
  replaces *all* rows of the file dates it covers and nothing else, so late events from
  one file never remove what other files said about the same day;
* gold: partitioned by month; a load replaces the months it has rows for;
* event days: for each file date of silver the days it has events for, and how many. A
  month is read from the file dates that this table names, and from those it lacks;
* stream batches: what a stream has done with each of its batches.

That an insert replaces the partitions it has rows for, and no others, is a property of
the tables, so no insert depends on what another one sets in the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pairpulse import schema
from pairpulse.config import EngineConfig
from pairpulse.functions.dates import Days, in_months
from pairpulse.functions.zorder import z_key
from pairpulse.operators import coverage
from pairpulse.sinks.staging import free_shuffles, size_of

_REPLACES_PARTITIONS = ("partitionOverwriteMode", "dynamic")
#: Partitions that one statement drops.
_DROPPED_AT_ONCE = 500
#: Bytes of staged rows from which a load is published in several inserts, and the most of them.
_INSERTED_AT_ONCE, _MOST_INSERTS = 256 << 20, 4


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    partitioned_by: tuple[str, ...]
    comment: str

    @property
    def database(self) -> str:
        return self.name.rsplit(".", 1)[0]

    def folder(self, root: str) -> str:
        """Where the table is kept below a root: the place of a managed one, too."""
        return f"{root.rstrip('/')}/{self.database}/{self.name.rsplit('.', 1)[1]}"

    @property
    def stored_columns(self) -> list[str]:
        """Column order of the stored table: partition columns last."""
        data = [c for c in self.schema.names if c not in self.partitioned_by]
        return data + list(self.partitioned_by)

    def create_sql(self, location: str | None = None) -> str:
        keys = ", ".join(f"`{c}`" for c in self.partitioned_by)
        ordered = T.StructType([self.schema[c] for c in self.stored_columns])
        option = "{} '{}'".format(*_REPLACES_PARTITIONS)
        where = f"\nLOCATION '{location}'" if location else ""
        return (f"CREATE TABLE IF NOT EXISTS {self.name} (\n  {schema.columns_ddl(ordered)}\n)\n"
                f"USING parquet\nOPTIONS ({option})\nPARTITIONED BY ({keys}){where}\n"
                f"COMMENT '{self.comment}'")

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows in schema order. Filters on partition columns prune directories."""
        return spark.table(self.name).select(*self.schema.names)


@dataclass(frozen=True)
class Lake:
    """The tables. ``prefix`` keeps several lakes apart in one catalog."""

    prefix: str = ""
    cfg: EngineConfig = EngineConfig()

    @property
    def bronze(self) -> Table:
        return Table(f"{self.prefix}bronze.events", schema.BRONZE, ("input_file_date",),
                     "Coded events as published, with file date and load time.")

    @property
    def silver(self) -> Table:
        return Table(f"{self.prefix}silver.events", schema.SILVER,
                     ("input_file_date",),
                     "Clean events between focus countries, one row per id and file date.")

    @property
    def event_days(self) -> Table:
        return Table(f"{self.prefix}silver.event_days", schema.EVENT_DAYS, ("input_file_date",),
                     "Days that each file date of silver has events for.")

    @property
    def gold(self) -> Table:
        return Table(f"{self.prefix}gold.suri", schema.gold_schema(self.cfg.measure_type),
                     ("year_month",), "Monthly directional unrest index per country pair.")

    @property
    def stream_batches(self) -> Table:
        return Table(f"{self.prefix}silver.stream_batches", schema.STREAM_BATCHES, ("stream", "batch_id"),
                     "What a stream has done with each of its batches.")

    @property
    def tables(self) -> list[Table]:
        return [self.bronze, self.silver, self.event_days, self.stream_batches, self.gold]

    def create(self, spark: SparkSession, root: str | None = None) -> None:
        """Create what does not exist yet, below ``root`` if one is given: managed tables, for
        a catalog that lasts."""
        purpose = {"bronze": "Event lines as they came, typed",
                   "silver": "Events between focus countries, one row per id",
                   "gold": "Monthly index per country pair"}
        for table in self.tables:
            where = f" LOCATION '{root}/{table.database}'" if root else ""
            layer = table.database.removeprefix(self.prefix)
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database} "
                      f"COMMENT '{purpose[layer]}'{where}")
            spark.sql(table.create_sql())

    def attach(self, spark: SparkSession, root: str) -> None:
        """Register the tables below ``root`` in a catalog that does not know them, with the
        partitions that are there: this is how a process picks up what another one has
        published. Such a catalog sees partitions as of this call, so processes that share a
        root take turns. Tables that it does know only get partitions they lack.
        """
        for table in self.tables:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database} LOCATION '{root}/{table.database}'")
            spark.sql(table.create_sql(table.folder(root)))
            if self._is_stored(spark, root, table):
                spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")

    def _is_stored(self, spark: SparkSession, root: str, table: Table) -> bool:
        return _file_system(spark, root).exists(_path(spark, table.folder(root)))


def _insert(df: DataFrame, table: Table) -> None:
    """Replace the partitions present in ``df``, if the table was made to do so."""
    definition = df.sparkSession.sql(f"SHOW CREATE TABLE {table.name}").first()[0]
    option = "'{}' = '{}'".format(*_REPLACES_PARTITIONS)
    if option.lower() not in definition.lower():
        raise ValueError(f"{table.name}: an insert would replace the whole table; "
                         f"ALTER TABLE {table.name} SET SERDEPROPERTIES ({option.replace(' ', '')}) first")
    df.select(*table.stored_columns).write.insertInto(table.name, overwrite=True)


def publish(df: DataFrame, table: Table) -> None:
    """Replace the partitions present in ``df``.

    Rebalancing on the partition columns gives each partition few, well-sized files;
    adaptive execution splits a partition that holds most of the rows over many tasks.
    """
    _insert(df.hint("rebalance", *table.partitioned_by), table)


def _in_turns(staged: DataFrame, dates: Collection[dt.date]) -> Iterator[DataFrame]:
    """All rows of a load, in runs of file dates to be inserted one after the other.

    An insert shuffles whole rows, which take several times the space of the staged ones. What
    was shuffled before a run is freed, so the disks hold that of one run. Each run reads the
    staged rows again, so there are few of them, and one only if the load is small.
    """
    spark, ordered, key = staged.sparkSession, sorted(dates), F.col("input_file_date")
    size = size_of(staged)
    turns = min(-(-size // _INSERTED_AT_ONCE), _MOST_INSERTS, len(ordered))
    cuts = [ordered[i * len(ordered) // turns] for i in range(1, turns)]
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        if 4 * size > _INSERTED_AT_ONCE:
            free_shuffles(spark)
        rows = staged if lo is None else staged.filter(key >= F.lit(lo))
        # A row without a date is in the first run.
        yield rows if hi is None else rows.filter(key.isNull() | (key < F.lit(hi)))
    if 4 * size > _INSERTED_AT_ONCE:
        free_shuffles(spark)


def publish_by_day(staged: DataFrame, table: Table, dates: Collection[dt.date]) -> None:
    """:func:`publish` for the rows of a load, which has these file dates."""
    for rows in _in_turns(staged, dates):
        publish(rows, table)


def clustered(events: DataFrame, cfg: EngineConfig, leading: Sequence[str]) -> DataFrame:
    """Order rows by ``leading`` partition columns, then by the interleaved key of both
    country codes, so that row-group statistics skip on either code. The id, last in
    the range key, lets a pair with a large share of all rows span many tasks."""
    key = z_key(cfg)
    order: list[str | Column] = [*leading, key, "GlobalEventID"]
    return events.repartitionByRange(*order).sortWithinPartitions(*order)


def partition_values(spark: SparkSession, table: Table) -> DataFrame:
    """The catalog's partition list as rows of dates. Metadata only."""
    spec = F.col("partition")
    return spark.sql(f"SHOW PARTITIONS {table.name}").select(*[
        F.regexp_extract(spec, rf"(?:^|/){c}=([^/]*)", 1).try_cast("date").alias(c)
        for c in table.partitioned_by])


def drop_partitions(spark: SparkSession, table: Table, values: Collection[dt.date]) -> None:
    """Drop the partitions of these dates with their files; others are left alone.
    One short specification per date: bounded by the calendar, not by the data."""
    key = table.partitioned_by[0]
    ordered = sorted(values)
    folder = _external_folder(spark, table) if ordered else None
    for i in range(0, len(ordered), _DROPPED_AT_ONCE):
        part = ordered[i:i + _DROPPED_AT_ONCE]
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS "
                  + ", ".join(f"PARTITION ({key}=DATE'{d}')" for d in part))
        for d in part if folder else ():  # the catalog leaves the files of external tables
            _file_system(spark, folder).delete(_path(spark, f"{folder}/{key}={d}"), True)


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def _external_folder(spark: SparkSession, table: Table) -> str | None:
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").collect()}
    return facts["Location"] if facts.get("Type") == "EXTERNAL" else None


def _dates(rows: DataFrame) -> set[dt.date]:
    """One column of distinct dates: at most one row per calendar day."""
    return {r[0] for r in rows.collect()}


def publish_silver(silver: DataFrame, table: Table, days: Days, cfg: EngineConfig,
                   event_days: Table | None = None, dates: Collection[dt.date] | None = None) -> int:
    """Replace exactly the rows of the file dates ``days``; returns dropped partitions.

    The insert replaces the directories of file dates that have rows now; those of the
    days that have none are dropped after it. Event date leads the order, so row groups
    skip on it. ``event_days`` forgets these file dates first and learns them last: one that
    it does not know is read for every month, so no state in between hides rows.

    ``silver`` should be staged: its dates are read again. ``dates`` are the file dates it
    has rows of, if they are known.
    """
    spark = silver.sparkSession
    key = "input_file_date"

    def stored(of: Table) -> set[dt.date]:
        return _dates(partition_values(spark, of).filter(days.contains(F.col(key))))

    if event_days:
        drop_partitions(spark, event_days, stored(event_days))
    dates = set(_dates(silver.select(key).distinct()) if dates is None else dates)
    if dates:
        for rows in _in_turns(silver, dates):
            _insert(clustered(rows, cfg, [key, "event_date"]), table)
    stale = stored(table) - dates
    drop_partitions(spark, table, stale)
    if event_days and dates:
        publish(coverage.event_days(silver), event_days)
    return len(stale)


def file_dates_of(spark: SparkSession, lake: Lake, months: Collection[dt.date]) -> set[dt.date]:
    """File dates of silver that may have events of these months: those of which
    ``event_days`` says so, and those it does not know."""
    known = lake.event_days.read(spark)
    named = _dates(known.filter(in_months(F.col("event_date"), months)).select("input_file_date").distinct())
    unknown = _dates(partition_values(spark, lake.silver).join(
        partition_values(spark, lake.event_days), "input_file_date", "left_anti"))
    return named | unknown


def stored_event_days(spark: SparkSession, lake: Lake, days: Days) -> DataFrame:
    """``input_file_date, event_date`` of the stored file dates of these days: from
    ``event_days``, and from silver for those it does not know."""
    key = F.col("input_file_date")
    known = lake.event_days.read(spark).filter(days.contains(key)).select("input_file_date", "event_date")
    unknown = _dates(partition_values(spark, lake.silver).filter(days.contains(key)).join(
        partition_values(spark, lake.event_days), "input_file_date", "left_anti"))
    if not unknown:
        return known
    rest = lake.silver.read(spark).filter(Days.of(unknown).contains(key))
    return known.unionByName(coverage.event_days(rest).select("input_file_date", "event_date"))


def silver_of_months(spark: SparkSession, lake: Lake, months: Collection[dt.date],
                     before: dt.date | None = None) -> DataFrame:
    """Silver rows of these months, from file dates before ``before``. Opens the partitions
    that may have some and no others, however long the history is."""
    dates = {d for d in file_dates_of(spark, lake, months) if before is None or d < before}
    rows = lake.silver.read(spark)
    if not dates:
        return rows.filter(F.lit(False))
    return rows.filter(Days.of(dates).contains(F.col("input_file_date"))
                       & in_months(F.col("event_date"), months))
