"""Tables between processes, threads and months: event days, partitions, the batch ledger."""

import datetime as dt
import glob
import os
import random
import re
import subprocess
import sys
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from pairpulse import EngineConfig
from pairpulse.functions.dates import Days, in_months
from pairpulse.operators import serving, silver
from pairpulse.plans import backfill, jobs
from pairpulse.sinks.staging import staged_and_counted
from pairpulse.sinks.tables import (Lake, drop_partitions, file_dates_of, partition_values, publish,
                                    publish_silver, silver_of_months)
from pairpulse.sources import landing, lines, slots
from pairpulse.streaming import incremental
from samples import bronze, land, line, rows, slot_name

CFG = EngineConfig()
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def day(text):
    return dt.date.fromisoformat(text)


def new_lake(spark, path):
    lake = Lake(prefix=f"l_{uuid.uuid4().hex[:8]}_")
    lake.create(spark, str(path / lake.prefix))
    return lake


def event(i, of, file=None):
    return {"GlobalEventID": i, "Day": int(f"{day(of):%Y%m%d}"), "input_file_date": day(file or of)}


def published(spark, lake, *events, known=True):
    clean = silver.to_silver(bronze(spark, *events), CFG)
    dates = {e["input_file_date"] for e in events}
    publish_silver(clean, lake.silver, Days.of(dates), CFG, lake.event_days if known else None)


# Months of stored silver

@pytest.fixture(scope="module")
def three_years(spark, tmp_path_factory):
    """One file date a month for three years, and a late event of May 2023 in October 2024."""
    lake = new_lake(spark, tmp_path_factory.mktemp("years"))
    months = [dt.date(y, m, 10) for y in (2022, 2023, 2024) for m in range(1, 13)]
    published(spark, lake, *[event(i, str(d)) for i, d in enumerate(months)],
              event(99, "2023-05-30", "2024-10-10"))
    return lake


def opened(df):
    return {day(x) for f in df.inputFiles() for x in re.findall(r"input_file_date=(\d{4}-\d\d-\d\d)", f)}


def test_a_month_opens_its_own_file_dates_only(spark, three_years):
    may = silver_of_months(spark, three_years, [day("2023-05-01")])
    assert opened(may) == {day("2023-05-10"), day("2024-10-10")}
    assert rows(may, "GlobalEventID") == [(16,), (99,)]
    as_of = silver_of_months(spark, three_years, [day("2023-05-01")], before=day("2023-06-01"))
    assert opened(as_of) == {day("2023-05-10")}
    text = as_of._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(input_file_date" in text
    assert "GreaterThanOrEqual(event_date,2023-05-01)" in text and "LessThan(event_date,2023-06-01)" in text
    # Two distant months open what lies between them no more than one does.
    both = silver_of_months(spark, three_years, [day("2022-01-01"), day("2024-12-01")])
    assert opened(both) == {day("2022-01-10"), day("2024-12-10")}
    assert silver_of_months(spark, three_years, [day("2030-01-01")]).count() == 0


def test_the_gold_job_reads_no_other_file_date(spark, three_years, monkeypatch):
    read = []
    index_for = jobs.index_for
    monkeypatch.setattr(jobs, "index_for", lambda df, *a, **k: read.append(opened(df)) or index_for(df, *a, **k))
    assert jobs.run_gold(spark, three_years, {day("2023-05-01"): False}) == [day("2023-05-01")]
    assert read == [{day("2023-05-10"), day("2024-10-10")}]


def test_file_dates_without_event_days_are_read_for_every_month(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    published(spark, lake, event(1, "2025-01-10"), known=False)
    assert file_dates_of(spark, lake, [day("2024-03-01")]) == {day("2025-01-10")}
    published(spark, lake, event(2, "2025-02-10"))
    assert file_dates_of(spark, lake, [day("2025-02-01")]) == {day("2025-01-10"), day("2025-02-10")}
    published(spark, lake, event(1, "2025-01-10"))
    assert file_dates_of(spark, lake, [day("2025-02-01")]) == {day("2025-02-10")}


def test_event_days_follow_a_reload(spark, tmp_path, monkeypatch):
    lake = new_lake(spark, tmp_path)
    published(spark, lake, event(1, "2025-01-10"), event(2, "2024-12-31", "2025-01-10"), event(3, "2025-01-11"))
    kept = ["input_file_date", "event_date", "events"]
    assert len(rows(lake.event_days.read(spark), *kept)) == 3
    # A load that fails between the two tables leaves the file date unknown, hence read.
    from pairpulse.sinks import tables
    with monkeypatch.context() as m:
        m.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            published(spark, lake, event(1, "2025-01-09", "2025-01-10"))
    assert file_dates_of(spark, lake, [day("2020-01-01")]) == {day("2025-01-10")}
    published(spark, lake, event(1, "2025-01-09", "2025-01-10"))
    assert rows(lake.event_days.read(spark), *kept) == [(day("2025-01-10"), day("2025-01-09"), 1),
                                                        (day("2025-01-11"), day("2025-01-11"), 1)]
    nothing = silver.to_silver(bronze(spark, event(1, "2025-01-10")), CFG).filter("false")
    assert publish_silver(nothing, lake.silver, Days.one(day("2025-01-11")), CFG, lake.event_days) == 1
    assert rows(lake.event_days.read(spark), "input_file_date") == [(day("2025-01-10"),)]


def test_last_files_from_event_days(spark, tmp_path):
    lake, rng = new_lake(spark, tmp_path), random.Random(4)
    published(spark, lake, *[event(i, f"2025-01-{rng.randint(1, 9):02d}", f"2025-01-{rng.randint(9, 20):02d}")
                             for i in range(60)])
    stored = lake.silver.read(spark)
    kept = silver.latest_file_wins(stored, lake.event_days.read(spark))
    assert rows(kept, "GlobalEventID") == rows(silver.latest_file_wins(stored), "GlobalEventID")
    assert 0 < kept.count() < 60
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Actor1Name") and len(re.findall(r"FileScan parquet [^\n]*silver.events", text)) == 1


def test_ranges_of_months():
    found = str(in_months(F.col("d"), [day("2024-12-01"), day("2025-01-01"), day("2025-06-01")]))
    assert found.count(">=") == 2 and "2025-02-01" in found and "2025-07-01" in found


# One pair

def test_a_pair_deduplicates_as_all_events_do(spark):
    rng = random.Random(9)
    events = [event(rng.randint(1, 60), f"2025-01-{rng.randint(1, 3):02d}", f"2025-01-{rng.randint(3, 4):02d}") | {
        "Actor1CountryCode": rng.choice(["USA", "CHN", "RUS", None]), "Actor2CountryCode": rng.choice(["USA", "CHN"]),
        "NumMentions": rng.choice([None, 1, 2]), "AvgTone": rng.choice([None, 0.5])} for _ in range(600)]
    events += [e | {"GlobalEventID": None} for e in events[:40]]
    frame = bronze(spark, *events)
    only = serving.pair_codes(CFG, "United States", "China")
    for cfg in (CFG, EngineConfig(dedup_scope="global")):
        whole = silver.to_silver(frame, cfg).filter("Actor1CountryCode = 'USA' AND Actor2CountryCode = 'CHN'")
        assert rows(silver.to_silver(frame, cfg, only=only)) == rows(whole)
        needed = ["event_date", "Actor1CountryCode", "NumMentions"]
        assert rows(silver.to_silver(frame, cfg, needed, only)) == rows(whole, *needed)
    assert 0 < whole.count() < 60


def test_wide_columns_of_a_pair_travel_with_its_rows_only(spark, three_years):
    only = serving.pair_codes(CFG, "United States", "China")
    df = silver.to_silver(three_years.silver.read(spark).withColumn("Day", F.lit(20250101)), CFG, only=only)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_min\(CASE WHEN \(+Actor1CountryCode#\d+ = USA", text.replace("(isnotnull", "("))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and text.count("FileScan") == 1


# Tables of a root

def test_three_processes_share_a_root(tmp_path):
    root, folder = str(tmp_path / "lake"), tmp_path / "in"
    for i in range(1, 29):
        land(folder, dt.date(2025, 2, i), [line(GlobalEventID=i, Day=f"202502{i:02d}")])

    def run(*args):
        env = os.environ | {"PYTHONPATH": REPO, "SPARK_CONF_DIR": str(tmp_path / "conf")}
        os.makedirs(tmp_path / "conf", exist_ok=True)
        (tmp_path / "conf" / "spark-defaults.conf").write_text(
            "spark.master local[2]\nspark.sql.shuffle.partitions 2\nspark.ui.enabled false\n"
            f"spark.sql.warehouse.dir {tmp_path}/warehouse\nspark.checkpoint.dir {tmp_path}/scratch\n")
        done = subprocess.run([sys.executable, "-m", "pairpulse", *args, "--root", root], cwd=tmp_path, env=env,
                              capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-3000:]
        return done.stdout

    run("create")
    run("backfill", "--landing", str(folder), "--start", "2025-02-01", "--end", "2025-02-28")
    out = run("daily", "--landing", f"{folder}/{{day}}*", "--day", "2025-02-28")
    assert "datetime.date(2025, 2, 1)" in out  # the gate saw the days of the process before
    run("export", "--folder", str(tmp_path / "out"))
    text = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/out/*.csv/*.csv"))
    assert "2025-02-01,USA,CHN,28," in text


def test_dropped_partitions_of_a_root_stay_dropped(spark, tmp_path):
    lake, root = Lake(prefix=f"l_{uuid.uuid4().hex[:8]}_"), str(tmp_path / "root")
    lake.attach(spark, root)
    publish(bronze(spark, event(1, "2025-01-10"), event(2, "2025-01-11")), lake.bronze)
    drop_partitions(spark, lake.bronze, [day("2025-01-10"), day("2025-03-01")])
    for table in lake.tables:
        spark.sql(f"DROP TABLE {table.name}")
    lake.attach(spark, root)
    assert rows(lake.bronze.read(spark), "GlobalEventID") == [(2,)]
    assert not glob.glob(f"{tmp_path}/*/*bronze/events/input_file_date=2025-01-10")
    assert spark.sql(f"SHOW PARTITIONS {lake.bronze.name}").count() == 1


def test_inserts_of_several_threads_keep_each_others_rows(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    publish(bronze(spark, event(0, "2025-01-01")), lake.bronze)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    failed = []

    def insert(month):
        try:
            for _ in range(2):
                publish(bronze(spark, *[event(i, f"2025-{month:02d}-{i:02d}") for i in range(1, 9)]), lake.bronze)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=insert, args=(m,)) for m in (2, 3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert not failed
    assert partition_values(spark, lake.bronze).count() == lake.bronze.read(spark).count() == 25


def test_a_table_that_an_insert_would_empty_is_refused(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    spark.sql(f"DROP TABLE {lake.gold.name}")
    spark.sql(lake.gold.create_sql().replace("OPTIONS (partitionOverwriteMode 'dynamic')", ""))
    with pytest.raises(ValueError, match="SET SERDEPROPERTIES"):
        publish(spark.createDataFrame([], lake.gold.schema), lake.gold)


# Counting while staging

@pytest.mark.parametrize("n", [0, 1, 1000])
def test_counts_are_those_of_the_staged_rows(spark, n):
    df = spark.range(n).withColumn("part", F.col("id") % 3).repartition(5)
    metrics = {"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1), "parts": F.collect_set("part")}
    with staged_and_counted(df, "counted", metrics) as (kept, found):
        assert kept.count() == found["rows"] == n and found["odd"] == n // 2
        assert set(found["parts"]) == set(range(min(n, 3)))


# Landing areas by day

def test_a_daily_run_lists_its_own_day(spark, tmp_path, monkeypatch):
    days = [dt.date(2025, 1, i) for i in range(1, 6)]
    for i, d in enumerate(days):
        land(tmp_path / f"{d:%Y%m%d}", d, [line(GlobalEventID=i, Day=f"{d:%Y%m%d}")])
        land(tmp_path / f"{d:%Y%m%d}", d, [line(GlobalEventID=i)], archive=True)
    area = f"{tmp_path}/{{day}}"
    assert landing.paths_of(spark, area, Days.one(days[1])) == [f"{tmp_path}/20250102"]
    assert landing.paths_of(spark, area, Days.one(dt.date(2025, 3, 1))) == []
    assert landing.paths_of(spark, area, Days(days[0], dt.date(2025, 6, 1))) == [f"{tmp_path}/*"]
    assert landing.paths_of(spark, str(tmp_path), Days.one(days[1])) == [str(tmp_path)]
    two = Days(days[1], days[3])
    assert lines.read_tsv(spark, area, two).count() == 2
    assert lines.list_archives(spark, area, two).count() == 2
    assert slots.landed_slots(spark, area, CFG, two).count() == 2
    none = Days.one(dt.date(2025, 3, 1))
    assert lines.read_tsv(spark, area, none).dtypes == lines.read_tsv(spark, area, two).dtypes
    assert lines.read_archives(spark, area, none).count() == lines.read_tsv(spark, area, none).count() == 0
    with pytest.raises(slots.NoInputError) as raised:
        jobs.check_arrivals(spark, area, Days.one(dt.date(2025, 3, 1)), CFG)
    assert raised.value.days == [dt.date(2025, 3, 1)]
    lake = new_lake(spark, tmp_path)
    assert backfill.run_daily(spark, lake, area, days[2]) == []
    assert rows(lake.silver.read(spark), "GlobalEventID") == [(2,)]


def test_strays(spark, tmp_path):
    land(tmp_path, dt.date(2025, 1, 10), [line()])
    for name in ("readme.txt", "2025011000.export.CSV", "20251399000000.export.CSV"):
        (tmp_path / name).write_text("x")
    found = {os.path.basename(r.path) for r in landing.landing_strays(spark, str(tmp_path)).collect()}
    assert found == {"readme.txt", "2025011000.export.CSV", "20251399000000.export.CSV"}


# The stream

FIRST, END = dt.date(2025, 1, 28), dt.date(2025, 3, 3)


def days_between(start, end):
    return [start + dt.timedelta(days=i) for i in range((end - start).days)]


def fill(folder, quiet=(), missing=()):
    rng = random.Random(2)
    for d in days_between(FIRST, END):
        text = [line(GlobalEventID=i, Day=f"{d - dt.timedelta(days=rng.choice([0, 0, 1, 25])):%Y%m%d}",
                     EventRootCode=rng.choice(["10", "01"])) for i in range(4)]
        text.append(line(GlobalEventID=9, Day=f"{d:%Y%m%d}"))
        if d in quiet:
            text = [line(Actor1CountryCode="AUS")]
        if d not in missing:
            land(folder, d, text)


def gold_rows(spark, lake):
    return rows(lake.gold.read(spark).drop("ingested_at"))


def stream(spark, lake, folder, checkpoint, files=100):
    incremental.load_landed(spark, lake, str(folder), str(checkpoint), files_per_batch=files).awaitTermination()


@pytest.fixture(scope="module")
def area(tmp_path_factory):
    folder = tmp_path_factory.mktemp("area")
    fill(folder, quiet={dt.date(2025, 2, 10)}, missing={dt.date(2025, 2, 20)})
    return folder


@pytest.fixture(scope="module")
def expected(spark, area, tmp_path_factory):
    """A backfill that skips the two days, with the index as of all files."""
    lake = new_lake(spark, tmp_path_factory.mktemp("expected"))
    skip = {dt.date(2025, 2, 10), dt.date(2025, 2, 20)}
    backfill.run_backfill(spark, lake, str(area), FIRST, END, skip, as_of_month_end=False)
    return lake


@pytest.mark.parametrize("files", [100, 9])
def test_stream_to_gold_equals_a_backfill_and_no_quiet_day_stops_it(spark, area, expected, tmp_path, files):
    lake = new_lake(spark, tmp_path)
    stream(spark, lake, area, tmp_path / "ckpt", files)
    assert gold_rows(spark, lake) == gold_rows(spark, expected) != []
    assert rows(lake.silver.read(spark).drop("ingested_at")) == rows(expected.silver.read(spark).drop("ingested_at"))
    ledger = lake.stream_batches.read(spark).collect()
    assert {r.state for r in ledger} == {"done"}
    assert [d for r in ledger for d in r.set_aside] == [dt.date(2025, 2, 10)]
    assert sorted(d for r in ledger for d in r.file_dates) == [
        d for d in days_between(FIRST, END) if d != dt.date(2025, 2, 20)]


def test_a_batch_that_failed_is_repeated_and_one_that_is_done_is_not(spark, area, expected, tmp_path, monkeypatch):
    lake, name = new_lake(spark, tmp_path), incremental.stream_name("here")
    days = [d for d in days_between(FIRST, END) if d != dt.date(2025, 2, 20)]
    for step in ("run_silver", "refresh_index"):
        with monkeypatch.context() as m:
            m.setattr(incremental, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                incremental.load_batch(spark, lake, str(area), name, 0, days)
        assert incremental.ledger_row(spark, lake, name, 0).state == "started"
    incremental.load_batch(spark, lake, str(area), name, 0, days)
    assert gold_rows(spark, lake) == gold_rows(spark, expected)
    with monkeypatch.context() as m:
        m.setattr(incremental, "run_bronze", lambda *a, **k: pytest.fail("done already"))
        incremental.load_batch(spark, lake, str(area), name, 0, days)


def test_months_that_lose_their_events_lose_their_index(spark, tmp_path, monkeypatch):
    lake, folder, name = new_lake(spark, tmp_path), tmp_path / "in", "s"
    for d in days_between(dt.date(2025, 1, 30), dt.date(2025, 3, 2)):
        land(folder, d, [line(GlobalEventID=1, Day=f"{d:%Y%m%d}")])
    days = days_between(dt.date(2025, 1, 30), dt.date(2025, 3, 2))
    incremental.load_batch(spark, lake, str(folder), name, 0, days)
    # Of January the run saw its last two days only; February is complete.
    assert rows(lake.gold.read(spark), "year_month", "total_events") == [(dt.date(2025, 2, 1), 28)]
    # The file of 14 February is replaced by one with an event of another month, and the
    # batch fails after silver is published: the repeated batch still knows of February.
    land(folder, dt.date(2025, 2, 14), [line(GlobalEventID=1, Day="20250131")])
    with monkeypatch.context() as m:
        m.setattr(incremental, "refresh_index", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental.load_batch(spark, lake, str(folder), name, 1, [dt.date(2025, 2, 14)])
    incremental.load_batch(spark, lake, str(folder), name, 1, [dt.date(2025, 2, 14)])
    assert gold_rows(spark, lake) == []
    land(folder, dt.date(2025, 2, 14), [line(GlobalEventID=1, Day="20250214")])
    incremental.load_batch(spark, lake, str(folder), name, 2, [dt.date(2025, 2, 14)])
    assert rows(lake.gold.read(spark), "total_events") == [(28,)]


def test_due_months():
    days = days_between(dt.date(2025, 1, 10), dt.date(2025, 4, 2))
    months = [dt.date(2024, 12, 1), *(dt.date(2025, m, 1) for m in range(1, 6))]
    whole = incremental.due_now(days, months)
    assert whole == {dt.date(2025, 1, 1): True, dt.date(2025, 2, 1): True, dt.date(2025, 3, 1): True}
    gap = incremental.due_now([d for d in days if d != dt.date(2025, 2, 28)], months)
    assert gap == whole | {dt.date(2025, 2, 1): False}
    assert incremental.due_now([], months) == {}


def test_bronze_rows_of_a_day_that_is_blank_now_are_dropped(spark, tmp_path):
    lake, folder = new_lake(spark, tmp_path), tmp_path / "in"
    days = [dt.date(2025, 1, 10), dt.date(2025, 1, 11)]
    for i, d in enumerate(days):
        land(folder, d, [line(GlobalEventID=i, Day=f"{d:%Y%m%d}")])
    incremental.load_batch(spark, lake, str(folder), "s", 0, days)
    (folder / slot_name(days[0])).write_text("\n")
    incremental.load_batch(spark, lake, str(folder), "s", 1, [days[0]])
    assert rows(lake.bronze.read(spark), "GlobalEventID") == rows(lake.silver.read(spark), "GlobalEventID") == [(1,)]
    assert incremental.ledger_row(spark, lake, "s", 1).set_aside == [days[0]]

