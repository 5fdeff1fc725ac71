"""Event rows derived from the star-schema test tables.

One event per ``lineitem`` row: the customer's country acts on the supplier's. Only the
dimensions that the requested columns need are joined. All joins are left joins on a
unique key, so leaving one out never changes the rows; sizes are left to Spark, which
broadcasts a side only when its statistics are below the session's threshold and splits
skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairpulse import schema

# Country by nation key, actor types by market segment and part type,
# late arrival by part key.
_COUNTRY = """CASE WHEN {key} BETWEEN 0 AND 19 THEN
      element_at(array('USA', 'CHN', 'RUS', 'GBR', 'UKR', 'ISR', 'IRN', 'TWN'), CAST({key} % 8 + 1 AS INT))
    WHEN {key} IN (20, 22, 24) THEN 'JPN' WHEN {key} = 21 THEN 'AUS' END"""
_TYPE1 = """CASE c_mktsegment WHEN 'BUILDING' THEN 'GOV' WHEN 'AUTOMOBILE' THEN 'REB'
    WHEN 'MACHINERY' THEN 'COP' WHEN 'FURNITURE' THEN 'CVL' END"""
_TYPE2 = """CASE p_type WHEN 'ECONOMY' THEN 'GOV' WHEN 'LARGE' THEN 'GOV' WHEN 'STANDARD' THEN 'OPP'
    WHEN 'SMALL' THEN 'EDU' WHEN 'MEDIUM' THEN 'CVL' END"""
_FILE_DATE = """date_add(to_date(l_shipdate),
    CASE l_partkey % 10 WHEN 0 THEN 7 WHEN 1 THEN 30 ELSE 0 END)"""
_DAY = "(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate))"
_ID = "(l_orderkey * 8 + l_linenumber)"
_ROOT = "lpad(CAST(l_partkey % 20 + 1 AS STRING), 2, '0')"
_COUNTRY1, _COUNTRY2 = _COUNTRY.format(key="c_nationkey"), _COUNTRY.format(key="s_nationkey")

_EXPRESSIONS = {
    "GlobalEventID": _ID,
    "Day": _DAY,
    "MonthYear": f"{_DAY} DIV 100",
    "Year": "year(l_shipdate)",
    "FractionDate": "year(l_shipdate) + 0.5D",
    "Actor1Code": f"concat({_COUNTRY1}, {_TYPE1})",
    "Actor1Name": "c_name",
    "Actor1CountryCode": _COUNTRY1,
    "Actor1Type1Code": _TYPE1,
    "Actor2Code": f"concat({_COUNTRY2}, {_TYPE2})",
    "Actor2Name": "s_name",
    "Actor2CountryCode": _COUNTRY2,
    "Actor2Type1Code": _TYPE2,
    "IsRootEvent": "l_linenumber % 2",
    "EventCode": f"concat({_ROOT}, '0')",
    "EventBaseCode": f"concat({_ROOT}, '0')",
    "EventRootCode": _ROOT,
    "QuadClass": "l_partkey % 4 + 1",
    "GoldsteinScale": "(l_partkey % 41 - 20) / 2.0D",
    "NumMentions": "l_quantity",
    "NumSources": "l_linenumber",
    "NumArticles": "floor(l_quantity / 2)",
    "AvgTone": "(l_quantity - 25) / 4.0D",
    "DATEADDED": f"date_format({_FILE_DATE}, 'yyyyMMdd')",
    "SOURCEURL": f"concat('src/', CAST({_ID} AS STRING))",
    "input_file_date": _FILE_DATE,
}
for _place in ("Actor1", "Actor2", "Action"):
    _EXPRESSIONS |= {
        f"{_place}Geo_Type": "1",
        f"{_place}Geo_Lat": "(l_suppkey % 361 - 180) * 0.25D",
        f"{_place}Geo_Long": "(l_suppkey % 721 - 360) * 0.25D",
    }

# A dimension is joined when an expression reads one of its columns.
_ACTOR1 = ("c_nationkey", "c_name", "c_mktsegment")
_ACTOR2 = ("s_nationkey", "s_name")
_PART = ("p_type",)

EVENT_COLUMNS = schema.EVENT_FIELDS.names + ["input_file_date"]


def star_events(spark: SparkSession, sf_dir: str, columns: Sequence[str] = EVENT_COLUMNS,
                slot: str | None = None) -> DataFrame:
    """Bronze-shaped rows (without a load time) with the requested columns.

    ``slot``, a format of the file date, adds a column of that name that the rows are spread
    and ordered by. They travel as the few columns that events are made of, which are a
    fraction of an event, and adaptive execution splits a day that holds most of them.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    wanted = {n: _EXPRESSIONS.get(n, "NULL") for n in columns}

    def reads(names: tuple[str, ...]) -> bool:
        return any(n in e for e in wanted.values() for n in names)

    rows = table("lineitem")
    # Parts first, which are too many to broadcast: rows that have no names yet are shuffled for them.
    if reads(_PART):
        rows = rows.join(table("part"), F.expr("l_partkey = p_partkey"), "left")
    if reads(_ACTOR1):
        # Orders meet customers first, so that line items are shuffled once for both.
        # Line items and orders grow together: neither is ever to be broadcast.
        actors = table("orders").join(table("customer"), F.expr("o_custkey = c_custkey"), "left")
        rows = rows.join(actors.hint("merge"), F.expr("l_orderkey = o_orderkey"), "left")
    if reads(_ACTOR2):
        rows = rows.join(table("supplier"), F.expr("l_suppkey = s_suppkey"), "left")
    if slot:
        rows = rows.withColumn("slot", F.date_format(F.expr(_FILE_DATE), slot))
        rows = rows.hint("rebalance", "slot").sortWithinPartitions("slot")
    kinds = {f.name: f.dataType.simpleString() for f in schema.BRONZE}
    return rows.selectExpr(*(["slot"] if slot else []),
                           *[f"CAST({e} AS {kinds[n]}) AS {n}" for n, e in wanted.items()])
