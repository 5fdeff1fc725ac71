"""Rows with an edge: NULLs, malformed fields, ties, overflow."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pairpulse import EngineConfig, schema
from pairpulse.functions.dates import Days, event_date, file_date
from pairpulse.functions.zorder import code_id, z_key
from pairpulse.operators import coverage, gold, quality, serving, silver
from pairpulse.operators.bronze import to_bronze
from pairpulse.sources import lines
from samples import LOADED, bronze, land, line, rows

CFG = EngineConfig()
DAY = dt.date(2025, 1, 10)


def test_schemas():
    assert [len(s.names) for s in (schema.EVENT_FIELDS, schema.BRONZE, schema.SILVER, schema.GOLD)] \
        == [61, 63, 27, 16]
    assert len(CFG.focus_countries) == 26
    assert schema.gold_schema("bigint")["total_events"].dataType.simpleString() == "bigint"


def test_config_rejects_unknown_values():
    with pytest.raises(ValueError):
        EngineConfig(measure_type="short")
    with pytest.raises(ValueError):
        EngineConfig(dedup_scope="none")
    with pytest.raises(ValueError):
        EngineConfig(country_names={})


def test_event_date_equals_pattern_parsing(spark):
    rng = random.Random(7)
    values = [None, 0, -1, 2025, 202501, 2025101, 1010101, 9999999, 10000000, 10000101, 20250229,
              20240229, 20251399, 20250100, 20250132, 99991231, 99991301, 120250101, 202501011,
              2**31 - 1, -2**31]
    values += [rng.randint(0, 99999999) for _ in range(2000)]
    values += [rng.randint(1000, 9999) * 10000 + rng.randint(0, 13) * 100 + rng.randint(0, 33)
               for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "Day int")
    parsed = F.try_to_date(F.col("Day").cast("string"), "yyyyMMdd")
    different = df.filter(~event_date(F.col("Day")).eqNullSafe(parsed))
    assert different.collect() == []
    assert df.filter(event_date(F.col("Day")).isNotNull()).count() > 3000


def test_file_date_from_path(spark):
    paths = ["/x/20250110001500.export.CSV.zip", "/x/slot=20250111000000.export.CSV/part-0.txt",
             "/x/20251399001500.export.CSV", "/x/readme.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(file_date(F.col("p"))).collect()] == [
        DAY, dt.date(2025, 1, 11), None, None]


def test_days():
    days = Days.of([dt.date(2025, 1, 1), dt.date(2025, 1, 4)])
    assert (days.start, days.end) == (dt.date(2025, 1, 1), dt.date(2025, 1, 5))
    assert days.skip == {dt.date(2025, 1, 2), dt.date(2025, 1, 3)}


# --- raw lines ------------------------------------------------------------------------

IRREGULAR = [
    line(GlobalEventID=1, Actor1Name='"quo'),
    line(GlobalEventID=2, Actor1Name='ab"c'),
    "3\t20250110",
    line(GlobalEventID=4) + "\textra",
    line(GlobalEventID=5, Actor1Name=None),
    "",
]


@pytest.mark.parametrize("archive", [False, True])
def test_irregular_lines(spark, tmp_path, archive):
    land(tmp_path, DAY, IRREGULAR, archive=archive)
    read = lines.read_archives if archive else lines.read_tsv
    out = to_bronze(read(spark, str(tmp_path)), ingested_at=LOADED, diagnostics=True)
    assert rows(out, "GlobalEventID", "Actor1Name", "EventRootCode", "malformed_line") == [
        (1, '"quo', "14", False), (2, 'ab"c', "14", False), (3, None, None, True),
        (4, None, "14", True), (5, None, "14", False)]
    assert out.select("input_file_date").distinct().collect()[0][0] == DAY
    assert out.schema["GlobalEventID"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("archive", [False, True])
def test_quoting_can_be_restored(spark, tmp_path, archive):
    text = "1\t20250110\t\"a\tb\"\t" + "\t".join([""] * 58)
    land(tmp_path, DAY, [text], archive=archive)
    read = lines.read_archives if archive else lines.read_tsv
    assert read(spark, str(tmp_path), quote='"').select("MonthYear").first()[0] == "a\tb"
    assert read(spark, str(tmp_path)).select("MonthYear").first()[0] == '"a'


def test_unreadable_archives_do_not_stop_the_others(spark, tmp_path):
    import zipfile
    land(tmp_path, DAY, [line()], 0, archive=True)
    (tmp_path / "20250110001500.export.CSV.zip").write_bytes(b"junk")
    with zipfile.ZipFile(tmp_path / "20250110003000.export.CSV.zip", "w") as z:
        z.writestr("other.txt", "x")
    with zipfile.ZipFile(tmp_path / "20250110004500.export.CSV.zip", "w") as z:
        z.writestr("first.CSV", line(GlobalEventID=8) + "\n")
        z.writestr("second.CSV", line(GlobalEventID=9) + "\n")
    raw = lines.read_archives(spark, str(tmp_path))
    errors = [r.read_error for r in raw.filter("read_error IS NOT NULL").orderBy("source_path").collect()]
    assert errors[0].startswith("BadZipFile") and errors[1] == "no .CSV member"
    assert rows(to_bronze(raw), "GlobalEventID") == [(1,), (8,)]


def test_long_archive_is_read_in_batches(spark, tmp_path):
    n = lines._LINES_PER_BATCH * 2 + 5
    land(tmp_path, DAY, [line(GlobalEventID=i) for i in range(n)], archive=True)
    out = to_bronze(lines.read_archives(spark, str(tmp_path)))
    assert out.agg(F.count_distinct("GlobalEventID")).first()[0] == n


@pytest.mark.parametrize("n", [1, 5000, 8192, 8193, 20_000])
def test_a_damaged_archive_gives_no_line(spark, tmp_path, n):
    land(tmp_path, DAY, [line(GlobalEventID=i) for i in range(n)], archive=True)
    land(tmp_path, DAY, [line(GlobalEventID=-1)], 1, archive=True)
    path = tmp_path / "20250110000000.export.CSV.zip"
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    raw = lines.read_archives(spark, str(tmp_path))
    assert raw.filter("read_error IS NOT NULL").count() == 1
    assert rows(to_bronze(raw.filter("read_error IS NULL")), "GlobalEventID") == [(-1,)]


def test_an_archive_too_large_is_an_error_of_its_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "MAX_ARCHIVE_BYTES", 1000)
    land(tmp_path, DAY, [line(GlobalEventID=i) for i in range(500)], archive=True)
    land(tmp_path, DAY, [line(GlobalEventID=-1)], 1, archive=True)
    raw = lines.read_archives(spark, str(tmp_path))
    assert [r.read_error for r in raw.filter("read_error IS NOT NULL").collect()] == ["larger than 1000 bytes"]
    assert rows(to_bronze(raw.filter("read_error IS NULL")), "GlobalEventID") == [(-1,)]


@pytest.mark.parametrize("text, expected", [
    ("1.5", None), ("1e3", None), ("x", None), ("99999999999", None), ("", None),
    (" 12 ", 12), ("+7", 7), ("-3", -3)])
def test_tolerant_int(spark, text, expected):
    raw = spark.createDataFrame([tuple(text if n == "NumMentions" else None for n in schema.RAW.names)],
                                schema.RAW)
    assert to_bronze(raw, file_date=DAY).select("NumMentions").first()[0] == expected


# --- silver ---------------------------------------------------------------------------

def test_both_countries_must_be_focus_countries(spark):
    df = bronze(spark, {"GlobalEventID": 1}, {"GlobalEventID": 2, "Actor1CountryCode": None},
                {"GlobalEventID": 3, "Actor2CountryCode": "AUS"},
                {"GlobalEventID": 4, "Actor1CountryCode": "CHN"})
    assert rows(silver.to_silver(df, CFG), "GlobalEventID") == [(1,), (4,)]


def test_rows_without_essentials_are_dropped(spark):
    df = bronze(spark, {"GlobalEventID": 1}, {"GlobalEventID": 2, "Day": 20251399},
                {"GlobalEventID": 3, "EventRootCode": None}, {"GlobalEventID": 4, "Day": None})
    out = silver.to_silver(df, CFG)
    assert out.columns == schema.SILVER.names
    assert rows(out, "GlobalEventID") == [(1,)]


def test_events_of_any_root_code_are_kept(spark):
    df = bronze(spark, {"GlobalEventID": 1, "EventRootCode": "01"}, {"GlobalEventID": 2})
    assert silver.to_silver(df, CFG).count() == 2


def test_rows_without_id_collapse_to_one(spark):
    df = bronze(spark, {"GlobalEventID": None, "NumMentions": 3}, {"GlobalEventID": None},
                {"GlobalEventID": 1})
    out = silver.to_silver(df, CFG)
    assert rows(out, "GlobalEventID", "NumMentions") == [(1, 10), (None, 3)]


def test_kept_copy_does_not_depend_on_row_order(spark):
    copies = [{"NumMentions": m, "Actor1Name": n} for m, n in
              ((5, "b"), (None, "z"), (None, "a"), (5, None))]
    for order in (copies, copies[::-1], copies[2:] + copies[:2]):
        out = silver.to_silver(bronze(spark, *order).repartition(3), CFG)
        assert rows(out, "NumMentions", "Actor1Name") == [(None, "a")]


def test_dedup_scope(spark):
    later = DAY + dt.timedelta(days=1)
    df = bronze(spark, {"input_file_date": later, "NumMentions": 1}, {"NumMentions": 9})
    assert rows(silver.to_silver(df, CFG), "input_file_date", "NumMentions") == [(DAY, 9), (later, 1)]
    out = silver.to_silver(df, replace(CFG, dedup_scope="global"))
    assert rows(out, "input_file_date", "NumMentions") == [(DAY, 9)]


@pytest.mark.parametrize("scope", ["file_date", "global"])
def test_narrow_silver_equals_the_same_columns_of_silver(spark, scope):
    cfg = replace(CFG, dedup_scope=scope)
    rng = random.Random(3)
    df = bronze(spark, *[{
        "GlobalEventID": rng.choice([None, 1, 2, 3]), "Day": 20250101 + rng.randint(0, 3),
        "Actor1Type1Code": rng.choice([None, "GOV", "REB"]), "NumMentions": rng.choice([None, 1, 2]),
        "EventRootCode": rng.choice(["10", "01"]), "AvgTone": rng.choice([None, 0.5]),
        "input_file_date": DAY + dt.timedelta(days=rng.randint(0, 2))} for _ in range(200)])
    full = silver.to_silver(df, cfg)
    for needed in (["event_date"], ["NumMentions"], ["GlobalEventID", "EventRootCode"], ["Actor2Code"],
                   ["input_file_date", "AvgTone", "Actor1Type1Code"], ["input_file_date"]):
        assert rows(silver.to_silver(df, cfg, needed)) == rows(full, *needed)


def test_one_id_holding_most_rows(spark):
    hot = spark.range(50_000).select(F.lit(7).alias("hot"), (F.col("id") % 97).alias("m"))
    base = bronze(spark, {"GlobalEventID": 7}).drop("NumMentions")
    df = base.crossJoin(hot).withColumn("NumMentions", F.col("m").cast("int")).select(*schema.BRONZE.names)
    assert rows(silver.to_silver(df, CFG), "GlobalEventID", "NumMentions") == [(7, 0)]


def test_duplicates(spark):
    df = silver.clean_events(bronze(spark, {}, {}, {"GlobalEventID": 2}), CFG)
    assert rows(silver.duplicate_ids(df, CFG), "GlobalEventID", "copies") == [(1, 2)]
    assert silver.duplicate_exists(df, CFG).first()[0]
    assert not silver.duplicate_exists(silver.dedup_events(df, CFG), CFG).first()[0]


def test_latest_file_wins_equals_one_write_per_file_date(spark):
    rng = random.Random(5)
    events = bronze(spark, *[{
        "GlobalEventID": i, "Day": 20250101 + rng.randint(0, 8),
        "input_file_date": dt.date(2025, 1, 1) + dt.timedelta(days=rng.randint(0, 9))} for i in range(120)])
    full = silver.to_silver(events, CFG)
    table = {}
    by_file = {}
    for r in full.select("input_file_date", "event_date", "GlobalEventID").collect():
        by_file.setdefault(r[0], {}).setdefault(r[1], set()).add((r[0], r[1], r[2]))
    for day in sorted(by_file):
        table.update(by_file[day])
    expected = sorted((x for part in table.values() for x in part), key=repr)
    assert rows(silver.latest_file_wins(full), "input_file_date", "event_date", "GlobalEventID") == expected


def test_z_key_is_a_bijection_that_interleaves(spark):
    codes = spark.createDataFrame([(c,) for c in CFG.focus_countries], "Actor1CountryCode string")
    pairs = codes.crossJoin(codes.toDF("Actor2CountryCode"))
    out = pairs.select(code_id(CFG, F.col("Actor1CountryCode")).alias("a"),
                       code_id(CFG, F.col("Actor2CountryCode")).alias("b"), z_key(CFG).alias("z")).collect()
    assert len({r.z for r in out}) == 676

    def interleave(a, b):
        return sum((a >> i & 1) << 2 * i | (b >> i & 1) << 2 * i + 1 for i in range(5))
    assert all(r.z == interleave(r.a, r.b) for r in out)
    other = spark.createDataFrame([("AUS", "USA"), (None, "USA")], "Actor1CountryCode string, Actor2CountryCode string")
    assert [r[0] for r in other.select(z_key(CFG)).collect()] == [None, None]


# --- gold -----------------------------------------------------------------------------

def index(spark, *events, cfg=CFG):
    events = [{"GlobalEventID": i} | e for i, e in enumerate(events)]
    return gold.monthly_index(silver.to_silver(bronze(spark, *events), cfg), cfg, LOADED)


def test_index_of_one_pair(spark):
    out = index(
        spark,
        {},                                                               # gov -> gov, unrest
        {"Actor1Type1Code": "REB", "EventRootCode": "10"},                # nongov -> gov, unrest
        {"Actor2Type1Code": "OPP", "EventRootCode": "13"},                # gov -> nongov, unrest
        {"Actor1Type1Code": None, "EventRootCode": "1"},                  # unknown -> gov
        {"Actor1Type1Code": "REB", "Actor2Type1Code": "REB", "EventRootCode": "010"})
    quality.check_columns(out, schema.GOLD, "gold")
    r = out.first()
    assert (r.year_month, r.total_events, r.geo_unrest_score) == (dt.date(2025, 1, 1), 5, 3)
    assert (r.total_gov_gov_events, r.total_ngov_gov_events, r.total_gov_ngov_events) == (1, 1, 1)
    assert (r.pol_involve_score, r.suri_score) == (0.6, 3 * 0.6)
    assert (r.total_mentions, r.total_sources, r.total_articles) == (50, 10, 25)
    assert (r.avg_goldstein, r.avg_tone, r.ingested_at) == (1.0, -1.5, LOADED)


def test_unknown_type_can_count_as_nongovernment(spark):
    rows_in = [{"Actor1Type1Code": None}, {"Actor2Type1Code": None},
               {"Actor1Type1Code": None, "Actor2Type1Code": None}]
    flows = ["total_gov_gov_events", "total_ngov_gov_events", "total_gov_ngov_events"]
    assert rows(index(spark, *rows_in), *flows) == [(0, 0, 0)]
    assert rows(index(spark, *rows_in, cfg=replace(CFG, null_type_is_nongov=True)), *flows) == [(0, 1, 1)]


def test_other_unrest_codes(spark):
    cfg = replace(CFG, unrest_root_codes=("18",))
    assert index(spark, {}, {"EventRootCode": "18"}, cfg=cfg).first().geo_unrest_score == 1


def test_direction_and_domestic_pairs(spark):
    out = index(spark, {}, {"Actor1CountryCode": "CHN", "Actor2CountryCode": "USA"},
                {"Actor2CountryCode": "USA"}, {"Day": 20250201})
    assert rows(out, "year_month", "Actor1CountryCode", "Actor2CountryCode") == [
        (dt.date(2025, 1, 1), "CHN", "USA"), (dt.date(2025, 1, 1), "USA", "CHN"),
        (dt.date(2025, 1, 1), "USA", "USA"), (dt.date(2025, 2, 1), "USA", "CHN")]


def test_sum_of_nulls_is_null(spark):
    r = index(spark, {"NumMentions": None, "AvgTone": None}, {"NumMentions": None, "AvgTone": None}).first()
    assert (r.total_mentions, r.avg_tone, r.total_sources) == (None, None, 4)


def test_overflow_raises_in_the_published_type_and_not_in_the_wide_one(spark):
    big = [{"NumMentions": 2**31 - 1}, {"NumMentions": 1}]
    with pytest.raises(Exception, match="OVERFLOW"):
        index(spark, *big).collect()
    wide = index(spark, *big, cfg=replace(CFG, measure_type="bigint"))
    assert wide.first().total_mentions == 2**31
    found = {r.check_name: r.violations for r in quality.gold_report(wide).collect()}
    assert found["count_overflow"] == 1
    with pytest.raises(quality.QualityError, match="count_overflow=1"):
        quality.enforce(quality.gold_report(wide), "gold")


# --- reports --------------------------------------------------------------------------

def found(report):
    return {r.check_name: r.violations for r in report.collect() if r.violations}


def test_bronze_report(spark):
    df = bronze(spark, {}, {"GlobalEventID": None}, {"input_file_date": DAY + dt.timedelta(days=1)},
                {"input_file_date": None})
    assert found(quality.bronze_report(df, Days.one(DAY))) == {
        "null_ids": 1, "extra_file_dates": 1, "null_file_dates": 1, "unexpected_file_dates": 1}
    assert found(quality.bronze_report(df.limit(0))) == {"empty": 1}


def test_silver_report(spark):
    df = silver.clean_events(bronze(spark, {}, {}, {"GlobalEventID": None}, {"GlobalEventID": None},
                                    {"input_file_date": DAY + dt.timedelta(days=1)}), CFG)
    assert found(quality.silver_report(df, Days.one(DAY))) == {
        "duplicate_ids": 2, "null_ids": 2, "extra_file_dates": 1, "unexpected_file_dates": 1}
    assert found(quality.silver_report(df.limit(0))) == {"empty": 1}
    with pytest.raises(quality.QualityError, match="duplicate_ids=2"):
        quality.enforce(quality.silver_report(df), "silver", {"extra_file_dates"})


@pytest.mark.parametrize("change, check", [
    ({"total_events": 0}, "no_events"), ({"geo_unrest_score": -1, "suri_score": 0.0,
                                          "pol_involve_score": 0.0}, "negative_unrest"),
    ({"pol_involve_score": 1.5, "suri_score": 1.5}, "involvement_out_of_range"),
    ({"suri_score": -1.0, "geo_unrest_score": -1, "pol_involve_score": 1.0}, "negative_index"),
    ({"suri_score": 1.02}, "index_mismatch"), ({"suri_score": None}, "null_scores")])
def test_gold_report(spark, change, check):
    df = index(spark, {})
    assert found(quality.gold_report(df)) == {}
    kinds = {f.name: f.dataType for f in schema.GOLD}
    bad = df.withColumns({k: F.lit(v).cast(kinds[k]) for k, v in change.items()})
    assert check in found(quality.gold_report(bad))


def test_small_drift_is_accepted(spark):
    df = index(spark, {}).withColumn("suri_score", F.col("suri_score") + 0.009)
    assert found(quality.gold_report(df)) == {}


def test_column_check(spark):
    df = index(spark, {})
    quality.check_columns(df, schema.GOLD, "gold")
    with pytest.raises(quality.QualityError):
        quality.check_columns(df.drop("avg_tone"), schema.GOLD, "gold")


# --- coverage and serving -------------------------------------------------------------

def test_coverage(spark):
    days = [20240201 + i for i in range(29)] + [20240301, 20240303]
    df = silver.to_silver(bronze(spark, *[{"GlobalEventID": i, "Day": d} for i, d in enumerate(days)]), CFG)
    assert rows(coverage.month_completeness(df)) == [
        (dt.date(2024, 2, 1), 29, 29, True), (dt.date(2024, 3, 1), 2, 31, False)]
    assert rows(coverage.complete_months(df)) == [(dt.date(2024, 2, 1),)]
    missing = rows(coverage.missing_days(df), "missing_date")
    assert len(missing) == 29 and (dt.date(2024, 3, 2),) in missing
    assert coverage.missing_days(df.limit(0)).collect() == []
    assert [r[0] for r in coverage.calendar(spark, DAY, DAY + dt.timedelta(days=2)).collect()] == [
        DAY, DAY + dt.timedelta(days=1)]


def test_serving(spark):
    df = index(spark, {"Day": 20250201}, {}, {"Actor1CountryCode": "CHN", "Actor2CountryCode": "USA"})
    cfg = replace(CFG, country_names={"USA": "United States"})
    named = serving.with_country_names(df, cfg)
    assert [r[0] for r in serving.country_choices(named, "target").collect()] == ["United States", None]
    named = serving.with_country_names(df, CFG)
    series = serving.pair_series(named, "United States", "China")
    assert [r.year_month for r in series.collect()] == [dt.date(2025, 1, 1), dt.date(2025, 2, 1)]
    assert serving.pair_message(series) is None
    assert serving.pair_message(serving.pair_series(named, "China", "China"))
    assert serving.pair_detail(named, "China", "United States").columns == serving.DETAIL_COLUMNS
