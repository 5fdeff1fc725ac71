"""The stream queries on rows of their own."""

import datetime as dt

import pytest

from pairpulse.catalogue import queries

DAYS = [dt.date(2025, 1, 30) + dt.timedelta(days=i) for i in range(4)]


@pytest.fixture
def tables(spark, tmp_path):
    """24 line items of four days, two orders, customers of the United States."""
    def write(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    write("lineitem", [(1 + i % 2, i // 2, 1 + i % 9, 1, 10.0 + i, dt.datetime.combine(DAYS[i % 4], dt.time())) for i in range(24)],
          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp_ntz")
    write("orders", [(1, 1), (2, 2)], "o_orderkey long, o_custkey long")
    write("customer", [(1, 0, "a", "BUILDING"), (2, 8, "b", None)],
          "c_custkey long, c_nationkey int, c_name string, c_mktsegment string")
    write("supplier", [(1, 1, "s")], "s_suppkey long, s_nationkey int, s_name string")
    write("part", [(i, "ECONOMY") for i in range(1, 10)], "p_partkey long, p_type string")
    return str(tmp_path)


def test_batches_of_a_stream_do_not_grow_with_the_files_of_a_day(spark, tables, monkeypatch):
    plain = queries._streamed(spark, tables)
    write = queries.fx.write_landing
    monkeypatch.setattr(queries.fx, "write_landing", lambda lines, path, **more: write(lines.repartition(6), path, **more))
    cut = queries._streamed(spark, tables)
    assert plain.stream_batches.read(spark).count() == cut.stream_batches.read(spark).count() == 2
    for one, other in ((plain.silver, cut.silver), (plain.gold, cut.gold)):
        rows = [sorted(map(str, t.read(spark).drop("ingested_at").collect())) for t in (one, other)]
        assert rows[0] == rows[1]
    assert plain.silver.read(spark).count() == 24
