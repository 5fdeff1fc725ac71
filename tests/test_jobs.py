"""Jobs from landed files to the index."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from pairpulse import EngineConfig
from pairpulse.config import outage_days
from pairpulse.functions.dates import Days
from pairpulse.operators import quality
from pairpulse.plans import backfill, jobs
from pairpulse.sinks.tables import Lake
from pairpulse.sources import slots
from pairpulse.streaming.incremental import load_landed
from samples import LOADED, land, line, rows, slot_name

CFG = EngineConfig()
FIRST, END = dt.date(2025, 2, 23), dt.date(2025, 3, 3)
OUTAGE = {dt.date(2025, 2, 25)}


def new_lake(spark, path):
    lake = Lake(prefix=f"j_{uuid.uuid4().hex[:8]}_")
    lake.create(spark, str(path / lake.prefix))
    return lake


def days_between(start, end):
    return [start + dt.timedelta(days=i) for i in range((end - start).days)]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    """A week around a month's end with duplicates, late events and a day missing."""
    folder = tmp_path_factory.mktemp("landing")
    rng = random.Random(11)
    for day in days_between(FIRST, END):
        if day in OUTAGE:
            continue
        for quarter in (0, 95):
            text = []
            for i in range(20):
                event = day - dt.timedelta(days=rng.choice([0, 0, 0, 1, 30]))
                text.append(line(
                    GlobalEventID=rng.randint(1, 40), Day=f"{event:%Y%m%d}",
                    Actor1CountryCode=rng.choice(["USA", "CHN", "AUS", None]),
                    Actor2CountryCode=rng.choice(["USA", "RUS"]),
                    EventRootCode=rng.choice(["10", "14", "01"]),
                    Actor1Type1Code=rng.choice(["GOV", "REB", None]), NumMentions=rng.randint(1, 9)))
            # One event per day that always counts, so that only the outage is a gap.
            text.append(line(GlobalEventID=1000 + quarter, Day=f"{day:%Y%m%d}"))
            land(folder, day, text, quarter)
    return str(folder)


def snapshot(spark, lake):
    return [rows(t.read(spark).drop("ingested_at")) for t in (lake.bronze, lake.silver, lake.gold)]


@pytest.fixture(scope="module")
def backfilled(spark, landing, tmp_path_factory):
    lake = new_lake(spark, tmp_path_factory.mktemp("backfilled"))
    built = backfill.run_backfill(spark, lake, landing, FIRST, END, OUTAGE, ingested_at=LOADED)
    return lake, built


def test_backfill_equals_one_day_after_the_other(spark, landing, backfilled, tmp_path):
    whole, built = backfilled
    # February lacks most of its days, but the outage lifts the gate.
    assert built == [dt.date(2025, 2, 1)]
    daily = new_lake(spark, tmp_path)
    full = True
    for day in days_between(FIRST, END):
        full = full or day.day == 1
        last = (day + dt.timedelta(days=1)).day == 1
        if day in OUTAGE:
            full = False
        else:
            jobs.run_bronze(spark, daily, landing, Days.one(day), ingested_at=LOADED)
            jobs.run_silver(spark, daily, Days.one(day))
        if last:
            jobs.run_gold(spark, daily, {day.replace(day=1): full}, ingested_at=LOADED)
    assert snapshot(spark, daily) == snapshot(spark, whole)


def test_rerun_changes_nothing(spark, landing, backfilled):
    lake, _ = backfilled
    before = snapshot(spark, lake)
    backfill.run_backfill(spark, lake, landing, FIRST, END, OUTAGE, ingested_at=LOADED)
    assert snapshot(spark, lake) == before


def test_stream_equals_batch(spark, landing, backfilled, tmp_path):
    lake = new_lake(spark, tmp_path)
    # Batches that end in the middle of a day.
    load_landed(spark, lake, landing, str(tmp_path / "ckpt"), files_per_batch=5).awaitTermination()
    assert snapshot(spark, lake)[:2] == snapshot(spark, backfilled[0])[:2]


def test_refresh_counts_late_events(spark, landing, backfilled, tmp_path):
    lake = new_lake(spark, tmp_path)
    backfill.run_backfill(spark, lake, landing, FIRST, END, OUTAGE)
    at_month_end = lake.gold.read(spark).agg(F.sum("total_events")).first()[0]
    touched = backfill.run_refresh(spark, lake, Days(dt.date(2025, 3, 1), END))
    assert touched in ([dt.date(2025, 2, 1)], [])
    silver = lake.silver.read(spark).filter("event_date BETWEEN '2025-02-01' AND '2025-02-28'")
    assert lake.gold.read(spark).agg(F.sum("total_events")).first()[0] == silver.count() >= at_month_end


def test_daily_run_builds_the_index_on_the_last_day_only(spark, tmp_path):
    lake, folder = new_lake(spark, tmp_path), tmp_path / "in"
    days = days_between(dt.date(2025, 2, 1), dt.date(2025, 3, 1))
    for i, day in enumerate(days):
        land(folder, day, [line(GlobalEventID=i, Day=f"{day:%Y%m%d}")], archive=True)
    assert backfill.run_daily(spark, lake, str(folder), days[0], archives=True) == []
    backfill.run_backfill(spark, lake, str(folder), days[0], days[-1], archives=True)
    assert lake.gold.read(spark).isEmpty()
    assert backfill.run_daily(spark, lake, str(folder), days[-1], archives=True) == [dt.date(2025, 2, 1)]
    assert lake.gold.read(spark).first().total_events == 28


def test_gate(spark, tmp_path):
    lake, folder, day = new_lake(spark, tmp_path), tmp_path / "in", dt.date(2025, 1, 31)
    land(folder, day, [line(Day="20250131")])
    assert backfill.run_daily(spark, lake, str(folder), day) == []
    assert jobs.run_gold(spark, lake, {dt.date(2025, 1, 1): False}) == [dt.date(2025, 1, 1)]
    with pytest.raises(quality.QualityError, match="2025-02-01"):
        jobs.run_gold(spark, lake, {dt.date(2025, 2, 1): False})
    assert jobs.run_gold(spark, lake, {}) == []


def test_wide_counts_are_published_in_their_type(spark, tmp_path):
    big = [line(GlobalEventID=i, NumMentions=2**31 - 1) for i in range(2)]
    land(tmp_path / "in", dt.date(2025, 1, 10), big)
    narrow = new_lake(spark, tmp_path)
    wide = Lake(prefix=narrow.prefix + "w", cfg=EngineConfig(measure_type="bigint"))
    wide.create(spark, str(tmp_path / wide.prefix))
    for lake in (narrow, wide):
        jobs.run_bronze(spark, lake, str(tmp_path / "in"), Days.one(dt.date(2025, 1, 10)))
        jobs.run_silver(spark, lake, Days.one(dt.date(2025, 1, 10)))
    with pytest.raises(quality.QualityError, match="count_overflow"):
        jobs.run_gold(spark, narrow, {dt.date(2025, 1, 1): False})
    jobs.run_gold(spark, wide, {dt.date(2025, 1, 1): False})
    assert wide.gold.read(spark).first().total_mentions == 2 * (2**31 - 1)


def test_a_failed_check_leaves_the_tables_as_they_were(spark, tmp_path):
    lake, day = new_lake(spark, tmp_path), dt.date(2025, 1, 10)
    land(tmp_path / "in", day, [line()])
    jobs.run_bronze(spark, lake, str(tmp_path / "in"), Days.one(day))
    jobs.run_silver(spark, lake, Days.one(day))
    before = snapshot(spark, lake)
    land(tmp_path / "in", day, [line(Actor1CountryCode="AUS")])
    jobs.run_bronze(spark, lake, str(tmp_path / "in"), Days.one(day))
    with pytest.raises(quality.QualityError, match="silver: empty=1"):
        jobs.run_silver(spark, lake, Days.one(day))
    assert snapshot(spark, lake)[1] == before[1]


def test_a_range_stops_at_every_day_without_rows(spark, tmp_path):
    days = days_between(dt.date(2025, 1, 10), dt.date(2025, 1, 13))
    lake, span = new_lake(spark, tmp_path), Days(days[0], days[-1] + dt.timedelta(days=1))
    for i, day in enumerate(days):
        land(tmp_path / "in", day, [line(GlobalEventID=i, Day=f"{day:%Y%m%d}")])
    jobs.run_bronze(spark, lake, str(tmp_path / "in"), span)
    jobs.run_silver(spark, lake, span)
    before = snapshot(spark, lake)
    # (a) a day with events outside the focus list only, (b) days with blank files.
    land(tmp_path / "in", days[1], [line(Actor1CountryCode="AUS")])
    jobs.run_bronze(spark, lake, str(tmp_path / "in"), span)
    with pytest.raises(quality.QualityError, match="silver: no rows for 2025-01-11$"):
        jobs.run_silver(spark, lake, span)
    assert snapshot(spark, lake)[1] == before[1]
    bronze = snapshot(spark, lake)[0]
    for day in days[1:]:
        (tmp_path / "in" / slot_name(day)).write_text("\n")
    with pytest.raises(quality.QualityError, match="bronze: no rows for 2025-01-11, 2025-01-12$"):
        jobs.run_bronze(spark, lake, str(tmp_path / "in"), span)
    assert snapshot(spark, lake)[0] == bronze


def test_arrivals_are_told_by_the_format_to_be_read(spark, tmp_path):
    days = days_between(dt.date(2025, 1, 10), dt.date(2025, 2, 10))
    for i, day in enumerate(days):
        land(tmp_path, day, [line()], archive=i == 1)
    span = Days(days[0], days[-1] + dt.timedelta(days=1))
    with pytest.raises(slots.NoInputError, match="for 2025-01-11$"):
        jobs.check_arrivals(spark, str(tmp_path), span, CFG, archives=False)
    with pytest.raises(slots.NoInputError) as raised:
        jobs.check_arrivals(spark, str(tmp_path), span, CFG, archives=True)
    assert str(raised.value).count("2025-") == len(days) - 1
    jobs.check_arrivals(spark, str(tmp_path), span, CFG)


def test_arrivals(spark, tmp_path):
    day = dt.date(2025, 1, 10)
    land(tmp_path, day, [line()], 1)
    land(tmp_path, day, [line()], 95, archive=True)
    expected = slots.expected_slots(jobs.days_frame(spark, Days.one(day)), CFG)
    names = [r.slot for r in expected.orderBy("slot").collect()]
    assert names == sorted(slot_name(day, q) + ".zip" for q in range(96))
    arrived = slots.landed_slots(spark, str(tmp_path), CFG, Days.one(day))
    missing = {r.slot for r in slots.missing_slots(expected, arrived).collect()}
    assert missing == set(names) - {names[1], names[95]}
    report = jobs.check_arrivals(spark, str(tmp_path), Days.one(day), CFG)
    assert rows(report) == [(day, 96, 2, 94)]
    with pytest.raises(slots.NoInputError, match="2025-01-11"):
        jobs.check_arrivals(spark, str(tmp_path), Days(day, day + dt.timedelta(days=2)), CFG)
    prefixed = EngineConfig(slot_prefix="https://example.org/")
    assert slots.expected_slots(jobs.days_frame(spark, Days.one(day)), prefixed).first().slot.startswith(
        "https://example.org/20250110")


def test_malformed_lines_are_reported_and_kept(spark, tmp_path):
    lake, day = new_lake(spark, tmp_path), dt.date(2025, 1, 10)
    land(tmp_path / "in", day, [line(), line(GlobalEventID=2) + "\textra", "3\t20250110"])
    (tmp_path / "in" / "20250110001500.export.CSV.zip").write_bytes(b"junk")
    with pytest.raises(Exception):
        jobs.run_bronze(spark, lake, str(tmp_path / "none"), Days.one(day))
    land(tmp_path / "zip", day, [line(), "3\t20250110"], archive=True)
    (tmp_path / "zip" / "20250110001500.export.CSV.zip").write_bytes(b"junk")
    report = jobs.run_bronze(spark, lake, str(tmp_path / "zip"), Days.one(day), archives=True)
    assert (report["malformed_lines"], report["read_errors"]) == (1, 1)
    assert rows(lake.bronze.read(spark), "GlobalEventID") == [(1,), (3,)]


def test_default_plan(spark):
    plan = {r.file_date: r for r in backfill.backfill_plan(spark, end=dt.date(2025, 9, 10)).collect()}
    assert min(plan) == dt.date(2025, 1, 1) and max(plan) == dt.date(2025, 9, 9)
    assert len(outage_days()) == 17
    skipped = sorted(d for d, r in plan.items() if not r.ingest)
    assert skipped == sorted(outage_days())
    due = {d: r.require_full_month for d, r in plan.items() if r.run_gold}
    assert due == {dt.date(2025, 1, 31): True, dt.date(2025, 2, 28): True, dt.date(2025, 3, 31): True,
                   dt.date(2025, 4, 30): True, dt.date(2025, 5, 31): True, dt.date(2025, 6, 30): False,
                   dt.date(2025, 7, 31): False, dt.date(2025, 8, 31): True}
    assert not plan[dt.date(2025, 6, 15)].require_full_month and plan[dt.date(2025, 6, 14)].require_full_month
