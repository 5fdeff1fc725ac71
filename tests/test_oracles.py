import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, differences
from pairpulse.catalogue.oracles import ORACLES
from pairpulse.catalogue.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 2131


# A folder per file date: run on two months of events here, on all of them outside the tests.
FOLDERS = {"tsv_roundtrip", "bronze_replay", "silver_replay", "backfill_tables", "stream_silver", "stream_gold",
           "gold_pruned", "landing_strays", "archive_files"}
# A run per day: on a few days before and after a month's end.
DAILY = {"daily_run"}


def tables_with(folder, of):
    """The smallest tables, with line items of some days only."""
    for path in glob.glob(f"{SMALL}/*.parquet"):
        kept = f"WHERE {of}" if "lineitem" in path else ""
        duckdb.sql(f"COPY (SELECT * FROM '{path}' {kept}) TO '{folder}/{os.path.basename(path)}'")
    return str(folder)


@pytest.fixture(scope="module")
def few(tmp_path_factory):
    return tables_with(tmp_path_factory.mktemp("few"), "year(l_shipdate) = 1995 AND month(l_shipdate) IN (3, 4)")


def test_daily_runs_equal_sql(spark, tmp_path):
    days = tables_with(tmp_path, "CAST(l_shipdate AS DATE) BETWEEN DATE '1995-03-19' AND DATE '1995-03-25'")
    for name in DAILY:
        assert differences(QUERIES[name](spark, days), connect(days), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(FOLDERS))
def test_folders_equal_sql(spark, few, name):
    assert differences(QUERIES[name](spark, few), connect(few), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FOLDERS - DAILY))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None
