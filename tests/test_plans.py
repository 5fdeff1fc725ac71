"""What the optimizer makes of the layers."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from pairpulse import EngineConfig, schema
from pairpulse.catalogue import fixtures as fx
from pairpulse.functions.dates import Days, within_months
from pairpulse.operators import coverage, gold, quality, serving, silver
from pairpulse.sinks.tables import Lake, publish, publish_silver
from pairpulse.sources import lines
from pairpulse.sources.star_events import star_events
from samples import bronze, land, line

CFG = EngineConfig()
SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single|Round)", plan(df)))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(prefix=f"p_{uuid.uuid4().hex[:8]}_")
    lake.create(spark, str(tmp_path_factory.mktemp("plans")))
    events = bronze(spark, *[{"GlobalEventID": i, "Day": 20250100 + i % 28 + 1,
                              "input_file_date": dt.date(2025, 1, 1 + i % 28)} for i in range(56)],
                    {"GlobalEventID": 99, "Day": 20250205, "input_file_date": dt.date(2025, 2, 5)})
    publish(events, lake.bronze)
    days = Days(dt.date(2025, 1, 1), dt.date(2025, 3, 1))
    publish_silver(silver.to_silver(events, CFG), lake.silver, days, CFG)
    return lake


def test_silver_job_prunes_file_dates_and_columns_and_shuffles_once(spark, lake):
    days = Days.one(dt.date(2025, 1, 3))
    source = lake.bronze.read(spark).filter(days.contains(F.col("input_file_date")))
    text = plan(silver.to_silver(source, CFG))
    assert re.search(r"PartitionFilters: \[isnotnull\(input_file_date#\d+\), \(input_file_date", text)
    assert "In(Actor1CountryCode" in text and "IsNotNull(EventRootCode)" in text
    scanned = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "Geo_" not in scanned and "SOURCEURL" not in scanned
    assert exchanges(silver.to_silver(source, CFG)) == 1


def test_hot_keys_are_combined_before_the_shuffle(spark, lake):
    text = plan(silver.to_silver(lake.bronze.read(spark), CFG))
    assert "partial_min" in text and "Window" not in text


def test_gold_prunes_months_and_columns_and_shuffles_once(spark, lake):
    rows = lake.silver.read(spark).filter(
        within_months(F.col("event_date"), dt.date(2025, 2, 1), dt.date(2025, 3, 1)))
    df = gold.monthly_index(rows, CFG)
    text = plan(df)
    assert "GreaterThanOrEqual(event_date,2025-02-01)" in text
    assert exchanges(df) == 1 and "partial_count" in text
    scanned = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "Actor1Name" not in scanned and "GlobalEventID" not in scanned
    df.collect()
    metrics = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in metrics


def test_coverage_reads_event_dates_only(spark, lake):
    text = plan(coverage.month_completeness(lake.silver.read(spark)))
    assert re.search(r"ReadSchema: struct<event_date:date>", text)


def test_a_pair_is_cut_out_by_code_in_the_scan(spark, lake):
    pair = ("United States", "China")
    for table in (lake.silver, lake.gold):
        rows = serving.for_pair(table.read(spark), CFG, *pair)
        text = plan(gold.monthly_index(rows, CFG) if table is lake.silver else rows)
        for code in ("Actor1CountryCode,USA", "Actor2CountryCode,CHN"):
            assert f"EqualTo({code})" in text


def test_latest_file_computes_wide_rows_once(spark):
    from pairpulse.catalogue.queries import QUERIES

    df = QUERIES["silver_latest_file_wins"](spark, SMALL)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    by_id = r"Exchange hashpartitioning\(input_file_date#\d+, GlobalEventID"
    assert "Window" not in text and "ReusedExchange [input_file_date" in text
    assert len(re.findall(rf"(?<!\], ){by_id}", text)) == 1
    # The join adds no shuffle of wide rows.
    assert not re.search(r"Exchange hashpartitioning\(event_date#\d+, input_file_date", text)


def test_silver_followed_by_its_report_shuffles_ids_once(spark, lake):
    df = quality.silver_report(silver.to_silver(lake.bronze.read(spark), CFG))
    assert len(re.findall(r"Exchange hashpartitioning\(input_file_date#\d+, GlobalEventID", plan(df))) == 1


def test_names_are_broadcast_from_literals(spark, lake):
    df = serving.with_country_names(gold.monthly_index(lake.silver.read(spark), CFG), CFG)
    text = plan(df)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_latest_file_join_needs_no_window(spark, lake):
    text = plan(silver.latest_file_wins(lake.silver.read(spark)))
    assert "LeftSemi" in text and "Window" not in text


def test_days_prune_the_landing_listing(spark, tmp_path):
    for i in range(1, 6):
        land(tmp_path, dt.date(2025, 1, i), [line(GlobalEventID=i)])
        land(tmp_path, dt.date(2025, 1, i), [line(GlobalEventID=i)], archive=True)
    for n, df in ((1, lines.read_tsv(spark, str(tmp_path), Days.one(dt.date(2025, 1, 2)))),
                  (2, lines.list_archives(spark, str(tmp_path), Days(dt.date(2025, 1, 2), dt.date(2025, 1, 4))))):
        assert re.search(r"DataFilters: \[.*substring\(regexp_extract\(file_path", plan(df))
        assert df.count() == n


def test_adapter_joins_only_what_is_read(spark):
    assert "Join" not in plan(star_events(spark, SMALL, ["GlobalEventID", "input_file_date"]))
    two = plan(star_events(spark, SMALL, ["Actor2CountryCode"]))
    assert two.count("BroadcastHashJoin") == 1
    full = plan(star_events(spark, SMALL, fx.BRONZE_FOR_SILVER))
    assert full.count("FileScan") == 5 and "s_acctbal" not in full


def test_reports_are_one_aggregation(spark, lake):
    df = quality.gold_report(gold.monthly_index(lake.silver.read(spark), CFG))
    assert plan(df).count("FileScan") == 1
    assert plan(quality.bronze_report(lake.bronze.read(spark))).count("FileScan") == 1


def test_published_columns(spark, lake):
    assert lake.silver.read(spark).columns == schema.SILVER.names
