"""Raw strings -> typed bronze rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from pairpulse import schema
from pairpulse.functions.dates import file_date as file_date_of


def cast_fields(raw: DataFrame) -> list[Column]:
    """The 61 fields in their types; a value that does not fit becomes NULL."""
    return [
        F.col(f.name) if f.dataType.simpleString() == "string"
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.EVENT_FIELDS
    ]


def load_time(ingested_at: dt.datetime | None) -> Column:
    return F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")


def to_bronze(
    raw: DataFrame,
    file_date: dt.date | None = None,
    ingested_at: dt.datetime | None = None,
    diagnostics: bool = False,
) -> DataFrame:
    """One projection: tolerant casts, file date, load time.

    ``file_date`` stamps every row with one date; without it the date comes from the
    name of the file each row was read from. ``diagnostics`` keeps what the reader
    reported about the line, for the quality report.
    """
    day = F.lit(file_date) if file_date else file_date_of(F.col(schema.SOURCE_PATH))
    columns = cast_fields(raw) + [
        day.cast("date").alias("input_file_date"),
        load_time(ingested_at).alias("ingested_at"),
    ]
    if diagnostics:
        columns += [F.col(c) for c in (schema.MALFORMED, schema.SOURCE_PATH, schema.READ_ERROR)]
    else:
        raw = raw.filter(F.col(schema.READ_ERROR).isNull()) if schema.READ_ERROR in raw.columns else raw
    return raw.select(*columns)
