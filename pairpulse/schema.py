"""Fixed schemas of the raw files and the three layers, and the DDL made from them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """One field per line: ``name TYPE`` and, optionally, ``-- comment``."""
    fields = []
    for line in text.strip().splitlines():
        decl, _, comment = line.partition("--")
        name, kind = decl.split()
        meta = {"comment": comment.strip()} if comment else {}
        fields.append(T.StructField(name, _TYPES[kind], True, meta))
    return T.StructType(fields)


# Position, name and type of the 61 fields of a raw event line.
EVENT_FIELDS = _struct("""
GlobalEventID BIGINT
Day INT
MonthYear INT
Year INT
FractionDate DOUBLE
Actor1Code STRING
Actor1Name STRING
Actor1CountryCode STRING
Actor1KnownGroupCode STRING
Actor1EthnicCode STRING
Actor1Religion1Code STRING
Actor1Religion2Code STRING
Actor1Type1Code STRING
Actor1Type2Code STRING
Actor1Type3Code STRING
Actor2Code STRING
Actor2Name STRING
Actor2CountryCode STRING
Actor2KnownGroupCode STRING
Actor2EthnicCode STRING
Actor2Religion1Code STRING
Actor2Religion2Code STRING
Actor2Type1Code STRING
Actor2Type2Code STRING
Actor2Type3Code STRING
IsRootEvent INT
EventCode STRING
EventBaseCode STRING
EventRootCode STRING
QuadClass INT
GoldsteinScale DOUBLE
NumMentions INT
NumSources INT
NumArticles INT
AvgTone DOUBLE
Actor1Geo_Type INT
Actor1Geo_Fullname STRING
Actor1Geo_CountryCode STRING
Actor1Geo_ADM1Code STRING
Actor1Geo_ADM2Code STRING
Actor1Geo_Lat DOUBLE
Actor1Geo_Long DOUBLE
Actor1Geo_FeatureID STRING
Actor2Geo_Type INT
Actor2Geo_Fullname STRING
Actor2Geo_CountryCode STRING
Actor2Geo_ADM1Code STRING
Actor2Geo_ADM2Code STRING
Actor2Geo_Lat DOUBLE
Actor2Geo_Long DOUBLE
Actor2Geo_FeatureID STRING
ActionGeo_Type INT
ActionGeo_Fullname STRING
ActionGeo_CountryCode STRING
ActionGeo_ADM1Code STRING
ActionGeo_ADM2Code STRING
ActionGeo_Lat DOUBLE
ActionGeo_Long DOUBLE
ActionGeo_FeatureID STRING
DATEADDED STRING
SOURCEURL STRING
""")

_METADATA = _struct("""
input_file_date DATE -- Date of the event file the row came from, taken from the file name.
ingested_at TIMESTAMP -- When the row was loaded.
""")

# A raw line before any cast: 61 strings and what the reader found out about it.
MALFORMED = "malformed_line"
SOURCE_PATH = "source_path"
READ_ERROR = "read_error"
RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_FIELDS])

BRONZE = T.StructType(EVENT_FIELDS.fields + _METADATA.fields)

# Name, order and type of the silver columns.
SILVER = _struct("""
GlobalEventID BIGINT
event_date DATE -- Date of the event, parsed from Day.
Actor1Code STRING
Actor1Name STRING
Actor1CountryCode STRING
Actor1KnownGroupCode STRING
Actor1Type1Code STRING
Actor1Type2Code STRING
Actor1Type3Code STRING
Actor2Code STRING
Actor2Name STRING
Actor2CountryCode STRING
Actor2KnownGroupCode STRING
Actor2Type1Code STRING
Actor2Type2Code STRING
Actor2Type3Code STRING
EventCode STRING
EventBaseCode STRING
EventRootCode STRING
QuadClass INT
GoldsteinScale DOUBLE
NumMentions INT
NumSources INT
NumArticles INT
AvgTone DOUBLE
input_file_date DATE -- Date of the event file the row came from.
ingested_at TIMESTAMP -- When the row was loaded into bronze.
""")

# Name, order and type of the gold columns.
GOLD = _struct("""
year_month DATE -- First day of the month observed.
Actor1CountryCode STRING -- Source country.
Actor2CountryCode STRING -- Target country.
total_events INT -- Events of the source country toward the target country.
geo_unrest_score INT -- Those of them with an unrest root code.
total_gov_gov_events INT -- Government toward government.
total_ngov_gov_events INT -- Known non-government toward government.
total_gov_ngov_events INT -- Government toward known non-government.
pol_involve_score DOUBLE -- Share of events that are in one of the three flows.
suri_score DOUBLE -- geo_unrest_score times pol_involve_score.
avg_goldstein DOUBLE -- Mean GoldsteinScale.
total_mentions INT -- Sum of NumMentions.
total_sources INT -- Sum of NumSources.
total_articles INT -- Sum of NumArticles.
avg_tone DOUBLE -- Mean AvgTone.
ingested_at TIMESTAMP -- When the row was computed.
""")

# What each file date of silver has events for.
EVENT_DAYS = _struct("""
event_date DATE -- Day the events are of.
events BIGINT -- Events of that day in files of this date.
input_file_date DATE -- File date of silver.
""")

_DATES = T.ArrayType(T.DateType())
# A row for each batch of a stream. Lists hold one date per day or month at most.
STREAM_BATCHES = T.StructType([
    T.StructField("state", T.StringType(), True, {"comment": "started or done."}),
    T.StructField("file_dates", _DATES, True, {"comment": "File dates of the files of the batch."}),
    T.StructField("set_aside", _DATES, True, {"comment": "Those of them without a row in silver."}),
    T.StructField("months", _DATES, True, {"comment": "Months whose index the batch may change."}),
    T.StructField("built", _DATES, True, {"comment": "Those of them that have an index now."}),
    T.StructField("stream", T.StringType(), True, {"comment": "Name made from the checkpoint."}),
    T.StructField("batch_id", T.LongType(), True, {"comment": "Number the stream gave the batch."}),
])

# Gold columns that follow EngineConfig.measure_type.
GOLD_COUNTS = [f.name for f in GOLD if f.dataType == T.IntegerType()]


def gold_schema(measure_type: str = "int") -> T.StructType:
    """The gold schema with its counts in the configured type."""
    wide = {"int": T.IntegerType(), "bigint": T.LongType()}[measure_type]
    return T.StructType([
        T.StructField(f.name, wide if f.name in GOLD_COUNTS else f.dataType, True, f.metadata)
        for f in GOLD])


def columns_ddl(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    out = []
    for f in schema:
        comment = f.metadata.get("comment")
        text = f" COMMENT '{comment}'" if comment else ""
        out.append(f"`{f.name}` {f.dataType.simpleString()}{text}")
    return ",\n  ".join(out)
