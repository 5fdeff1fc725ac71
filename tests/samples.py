"""Hand-written events."""

from __future__ import annotations

import datetime as dt
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession

from pairpulse import schema

LOADED = dt.datetime(2026, 1, 1, 12)

_BASE = {
    "GlobalEventID": 1, "Day": 20250110, "Actor1CountryCode": "USA", "Actor2CountryCode": "CHN",
    "Actor1Type1Code": "GOV", "Actor2Type1Code": "GOV", "EventRootCode": "14",
    "GoldsteinScale": 1.0, "NumMentions": 10, "NumSources": 2, "NumArticles": 5, "AvgTone": -1.5,
    "input_file_date": dt.date(2025, 1, 10), "ingested_at": LOADED,
}


def bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    full = [tuple((_BASE | r).get(n) for n in schema.BRONZE.names) for r in rows]
    return spark.createDataFrame(full, schema.BRONZE)


def line(**values) -> str:
    merged = {k: v for k, v in (_BASE | values).items() if k in schema.RAW.names}
    return "\t".join("" if merged.get(n) is None else str(merged[n]) for n in schema.RAW.names)


def slot_name(day: dt.date, quarter: int = 0) -> str:
    return f"{day:%Y%m%d}{quarter // 4:02d}{quarter % 4 * 15:02d}00.export.CSV"


def land(folder, day: dt.date, lines: list[str], quarter: int = 0, archive: bool = False) -> None:
    os.makedirs(folder, exist_ok=True)
    name, text = slot_name(day, quarter), "\n".join(lines) + "\n"
    if archive:
        with zipfile.ZipFile(f"{folder}/{name}.zip", "w") as z:
            z.writestr(name, text)
    else:
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
