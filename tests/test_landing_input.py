"""How the landing area of the queries is built from the star schema."""

import datetime as dt
import glob
import re
import time

import pytest

from pairpulse.catalogue import fixtures as fx, queries

N = 400


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Line items of three days; keys repeat and are missing, and so are dates."""
    root = str(tmp_path_factory.mktemp("star"))
    items = [(None if i % 50 == 7 else i, i % 20 if i % 11 else None, i % 9, i % 7, float(i % 50),
              None if i % 40 == 3 else dt.datetime(2025, 1, 1 + i % 3)) for i in range(N)]
    tables = {
        "lineitem": (items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_shipdate timestamp"),
        "orders": ([(i, i % 30) for i in range(0, N, 2)], "o_orderkey long, o_custkey long"),
        "customer": ([(i, f"c{i}", None if i == 3 else i % 25, "BUILDING") for i in range(25)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "supplier": ([(i, f"s{i}", i % 25) for i in range(8)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(i, "LARGE") for i in range(15)], "p_partkey long, p_type string"),
    }
    for name, (rows, columns) in tables.items():
        spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{root}/{name}.parquet")
    return root


def test_lines_are_the_same_whether_spread_before_or_not(spark, star):
    for planted in (False, True):
        plain, spread = (sorted(map(tuple, fx.event_lines(spark, star, planted, by).collect()), key=repr)
                         for by in (False, True))
        assert plain == spread and len(plain) == N
        fields = {line.count("\t") + 1 for _, line in plain}
        assert fields == ({59, 61, 62} if planted else {61})
    assert any(slot is None for slot, _ in plain)


def test_rows_are_spread_before_they_are_lines(spark, star):
    plan = fx.event_lines(spark, star, by_slot=True)._jdf.queryExecution().executedPlan().toString()
    assert "array_join" in plan
    spread = plan[plan.index("Exchange hashpartitioning(slot"):]
    assert "array_join" not in spread and "concat_ws" not in spread


@pytest.mark.parametrize("planted", [False, True])
def test_methods_that_make_lines_are_short_enough_to_be_compiled(spark, star, planted):
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fx.event_lines(spark, star, planted, by_slot=True)._jdf.queryExecution().executedPlan()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


def test_a_slot_is_a_file(spark, star, tmp_path):
    path = fx.write_landing(fx.event_lines(spark, star, by_slot=True), str(tmp_path / "in"))
    folders = glob.glob(f"{path}/slot=*")
    assert len(folders) > 3 and len(glob.glob(f"{path}/slot=*/*.txt")) == len(folders)


def test_an_area_of_which_only_names_are_read_is_compressed(spark, star, monkeypatch):
    made = []
    real = fx.write_landing
    monkeypatch.setattr(fx, "write_landing", lambda *a, **k: made.append(real(*a, **k)) or made[0])
    assert {r.kind for r in queries.landing_names(spark, star).collect()} == {"stray", "slot"}
    assert glob.glob(f"{made[0]}/slot=*/*.gz") and not glob.glob(f"{made[0]}/slot=*/*.txt")


def test_archives_are_packed_without_another_shuffle(spark, star):
    packed = fx.pack_archives(fx.event_lines(spark, star, planted=True, by_slot=True))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange hashpartitioning(slot" in plan


@pytest.mark.parametrize("query", [queries.tsv_roundtrip, lambda spark, star: queries._landed(spark, star)[0]])
def test_landed_lines_are_kept_compressed(spark, star, monkeypatch, query):
    made = []
    real = fx.write_landing
    monkeypatch.setattr(fx, "write_landing", lambda *a, **k: made.append(real(*a, **k)) or made[0])
    query(spark, star)
    assert glob.glob(f"{made[0]}/slot=*/*.gz") and not glob.glob(f"{made[0]}/slot=*/*.txt")


def test_compressed_lines_are_read_as_plain_ones(spark, star, monkeypatch):
    kept = sorted(map(tuple, queries.tsv_roundtrip(spark, star).collect()), key=repr)
    real = fx.write_landing
    monkeypatch.setattr(fx, "write_landing", lambda lines, path, **_: real(lines, path))
    plain = sorted(map(tuple, queries.tsv_roundtrip(spark, star).collect()), key=repr)
    assert kept == plain and len(kept) == N


def test_nothing_shuffled_for_the_landing_area_is_left(spark, star, tmp_path):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    before = shuffles()
    fx.write_landing(fx.event_lines(spark, star, by_slot=True), str(tmp_path / "in"))
    for _ in range(50):  # the cleaner works beside the session
        if shuffles() <= before:
            return
        time.sleep(0.1)
    raise AssertionError(f"{shuffles()} shuffles, {before} before")
