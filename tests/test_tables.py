"""State of the published tables after reruns, overlaps and interruptions."""

import datetime as dt
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairpulse import EngineConfig, schema
from pairpulse.functions.dates import Days
from pairpulse.functions.zorder import z_key
from pairpulse.operators import silver
from pairpulse.sinks import staging, tables
from pairpulse.sinks.extract import export_index_csv, extract_name
from pairpulse.sinks.tables import Lake, clustered, partition_values, publish, publish_by_day, publish_silver
from pairpulse.sources.extract import read_index_csv
from samples import bronze, rows
from test_edges import index

CFG = EngineConfig()
F1, F2 = dt.date(2025, 1, 10), dt.date(2025, 1, 11)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(prefix=f"t_{uuid.uuid4().hex[:8]}_")
    lake.create(spark, str(tmp_path / "lake"))
    return lake


def test_definitions(spark, lake):
    lake.create(spark)  # again, without effect
    for table in (lake.bronze, lake.silver, lake.gold):
        stored = spark.table(table.name)
        assert stored.columns == table.stored_columns
        read = table.read(spark)
        assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in table.schema]
    comments = {f.name: f.metadata.get("comment") for f in spark.table(lake.gold.name).schema}
    assert comments["suri_score"] and comments["year_month"]
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {lake.silver.name}").collect()}
    assert detail["Comment"].startswith("Clean events") and detail["Type"] == "MANAGED"
    assert "# Partitioning" in detail or "# Partition Information" in detail


def test_bronze_rerun_replaces_its_file_date_only(spark, lake):
    publish(bronze(spark, {"GlobalEventID": 1}, {"GlobalEventID": 2, "input_file_date": F2}), lake.bronze)
    publish(bronze(spark, {"GlobalEventID": 3, "input_file_date": F2}), lake.bronze)
    assert rows(lake.bronze.read(spark), "GlobalEventID") == [(1,), (3,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def clean(spark, *events):
    return silver.to_silver(bronze(spark, *events), CFG)


def stored(spark, lake):
    return rows(lake.silver.read(spark), "GlobalEventID", "input_file_date", "event_date")


def test_late_events_do_not_remove_what_other_files_said(spark, lake):
    first = clean(spark, {"GlobalEventID": 1, "Day": 20250110})
    second = clean(spark, {"GlobalEventID": 2, "Day": 20250110, "input_file_date": F2},
                   {"GlobalEventID": 3, "Day": 20250111, "input_file_date": F2})
    publish_silver(first, lake.silver, Days.one(F1), CFG)
    publish_silver(second, lake.silver, Days.one(F2), CFG)
    assert [r[0] for r in stored(spark, lake)] == [1, 2, 3]
    # The other mode keeps, per event date, the last file only.
    assert rows(silver.latest_file_wins(lake.silver.read(spark)), "GlobalEventID") == [(2,), (3,)]


def test_rerun_removes_stale_event_dates(spark, lake):
    day1 = {"GlobalEventID": 2, "Day": 20250110, "input_file_date": F2}
    day2 = {"GlobalEventID": 3, "Day": 20250111, "input_file_date": F2}
    publish_silver(clean(spark, {"GlobalEventID": 1}), lake.silver, Days.one(F1), CFG)
    assert publish_silver(clean(spark, day1, day2), lake.silver, Days.one(F2), CFG) == 0
    assert publish_silver(clean(spark, day2), lake.silver, Days.one(F2), CFG) == 0
    assert stored(spark, lake) == [(1, F1, F1), (3, F2, F2)]
    assert rows(partition_values(spark, lake.silver)) == [(F1,), (F2,)]
    # Same input again: same table.
    assert publish_silver(clean(spark, day2), lake.silver, Days.one(F2), CFG) == 0
    assert stored(spark, lake) == [(1, F1, F1), (3, F2, F2)]


def test_a_range_without_rows_empties_its_file_dates(spark, lake):
    publish_silver(clean(spark, {}, {"GlobalEventID": 2, "input_file_date": F2}), lake.silver,
                   Days(F1, F2 + dt.timedelta(days=1)), CFG)
    publish_silver(clean(spark, {"GlobalEventID": 2, "input_file_date": F2}), lake.silver,
                   Days(F1, F2 + dt.timedelta(days=1)), CFG)
    assert [r[0] for r in stored(spark, lake)] == [2]


def test_gold_rerun_replaces_its_month_only(spark, lake):
    publish(index(spark, {}, {"Day": 20250201}), lake.gold)
    publish(index(spark, {"Day": 20250201, "NumMentions": 1}), lake.gold)
    assert rows(lake.gold.read(spark), "year_month", "total_mentions") == [
        (dt.date(2025, 1, 1), 10), (dt.date(2025, 2, 1), 1)]


def test_layout_skips_on_either_country_and_splits_a_hot_pair(spark, tmp_path):
    codes = ["USA", "CHN", "RUS", "GBR", "UKR", "ISR", "IRN", "TWN"]
    code = lambda c: F.element_at(F.array(*[F.lit(x) for x in codes]), c.cast("int"))
    base = bronze(spark, {}).drop("GlobalEventID", "Actor1CountryCode", "Actor2CountryCode")
    spread = spark.range(40_000).select(
        F.col("id").alias("GlobalEventID"),
        code(F.col("id") % 8 + 1).alias("Actor1CountryCode"),
        code(F.floor(F.col("id") / 8) % 8 + 1).alias("Actor2CountryCode"))
    hot = spark.range(20_000).select((F.col("id") + 40_000).alias("GlobalEventID"),
                                     F.lit("USA").alias("Actor1CountryCode"),
                                     F.lit("CHN").alias("Actor2CountryCode"))
    df = silver.clean_events(base.crossJoin(spread.union(hot)), CFG)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered(df, CFG, ["event_date"]).write.parquet(str(tmp_path / "z"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "z").glob("*.parquet"))
    stats = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics
                    for i in range(meta.num_columns)}
            stats.append((meta.row_group(g).num_rows, cols["Actor1CountryCode"], cols["Actor2CountryCode"]))
    assert len(stats) >= 6 and max(n for n, *_ in stats) < 15_000
    for side in (1, 2):
        wanted = "TWN"
        touched = [s for s in stats if s[side].min <= wanted <= s[side].max]
        assert len(touched) < len(stats)


def test_published_files_keep_the_clustered_order(spark, lake, tmp_path):
    pairs = [(a, b) for a in ("USA", "CHN", "RUS", "TWN") for b in ("USA", "IRN", "GBR")]
    events = [{"GlobalEventID": i, "Actor1CountryCode": pairs[i * 7 % 12][0],
               "Actor2CountryCode": pairs[i * 7 % 12][1], "Day": 20250110 + i % 2} for i in range(240)]
    publish_silver(clean(spark, *events), lake.silver, Days.one(F1), CFG)
    files = spark.table(lake.silver.name).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"),
        "event_date", z_key(CFG).alias("z"), "GlobalEventID").collect()
    by_file = {}
    for r in sorted(files, key=lambda r: r.n):
        by_file.setdefault(r.file, []).append((r.event_date, r.z, r.GlobalEventID))
    assert len(files) == 240 and all(v == sorted(v) for v in by_file.values())


def test_staged_rows_are_computed_once_and_dropped(spark):
    noisy = spark.range(100).withColumn("x", F.rand())
    with staging.staged(noisy, "noisy") as kept:
        assert rows(kept) == rows(kept)
        assert spark.sql("SHOW TABLES IN pairpulse_stage").count() == 1
    assert spark.sql("SHOW TABLES IN pairpulse_stage").count() == 0


def test_scratch_folder_comes_from_the_session(spark):
    root = staging.scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert staging.new_scratch_path(spark, "x").startswith(f"{root}/x-")


def test_extract(spark, tmp_path):
    df = index(spark, {"Day": 20250201}, {}, {"Actor1CountryCode": "CHN", "NumMentions": None})
    path = export_index_csv(df, str(tmp_path), dt.date(2026, 3, 14))
    assert path.endswith(extract_name(dt.date(2026, 3, 14))) and path.endswith("_20260314.csv")
    parts = list((tmp_path / extract_name(dt.date(2026, 3, 14))).glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().startswith(",".join(schema.GOLD.names))
    back = read_index_csv(spark, path)
    assert rows(back) == rows(df)
    months = [r.year_month for r in back.collect()]
    assert months == sorted(months)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_index_csv(spark, str(tmp_path / "none.csv"))


def dated(spark, days):
    """A row of each day, two of the first, one without a day."""
    dates = [F1 + dt.timedelta(days=i) for i in range(days)]
    return dates, spark.createDataFrame(list(enumerate([*dates, F1, None])), "id long, input_file_date date")


@pytest.mark.parametrize("days, runs", [(1, 1), (3, 3), (11, 4)])
def test_a_large_load_is_inserted_in_runs_of_days_that_hold_every_row_once(spark, monkeypatch, days, runs):
    monkeypatch.setattr(tables, "_INSERTED_AT_ONCE", 1)
    dates, events = dated(spark, days)
    found = [rows(r) for r in tables._in_turns(events, dates)]
    assert len(found) == runs
    assert sorted(sum(found, []), key=repr) == sorted(rows(events), key=repr)
    spans = [{r[1] for r in run} - {None} for run in found]
    assert all(max(a) < min(b) for a, b in zip(spans, spans[1:])) and (days + 1, None) in found[0]


def test_a_small_load_is_one_insert(spark):
    dates, events = dated(spark, 11)
    with staging.staged(events, "small") as kept:
        assert len(list(tables._in_turns(kept, dates))) == 1


def test_a_load_in_runs_gives_the_tables_of_one_insert(spark, lake, tmp_path, monkeypatch):
    dates = [F1 + dt.timedelta(days=i) for i in range(6)]
    raw = bronze(spark, *[{"GlobalEventID": i, "input_file_date": dates[i % 6]} for i in range(30)])
    other = Lake(prefix=f"t_{uuid.uuid4().hex[:8]}_")
    other.create(spark, str(tmp_path / "other"))
    inserts, insert = [], tables._insert
    monkeypatch.setattr(tables, "_insert", lambda df, table: inserts.append(table.name) or insert(df, table))
    days = Days(F1, dates[-1] + dt.timedelta(days=1))
    for to, least in ((lake, tables._INSERTED_AT_ONCE), (other, 1)):
        monkeypatch.setattr(tables, "_INSERTED_AT_ONCE", least)
        with staging.staged(raw, "runs") as kept:
            publish_by_day(kept, to.bronze, dates)
        with staging.staged(silver.to_silver(raw, CFG), "runs") as kept:
            publish_silver(kept, to.silver, days, CFG, to.event_days, dates)
    assert [inserts.count(t.name) for t in (lake.bronze, lake.silver, other.bronze, other.silver)] == [1, 1, 4, 4]
    for one, two in zip(lake.tables[:3], other.tables[:3]):
        assert rows(one.read(spark)) == rows(two.read(spark)) != []
