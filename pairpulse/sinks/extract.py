"""CSV extract of the index for readers without a cluster."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def extract_name(stamp: dt.date, base: str = "gold.suri") -> str:
    return f"{base}_{stamp:%Y%m%d}.csv"


def export_index_csv(gold: DataFrame, folder: str, stamp: dt.date) -> str:
    """One header CSV below a date-stamped name; returns its path.

    A single file is what readers of the extract expect. The index has at most one row
    per ordered pair of configured countries and month, whatever the number of events.
    """
    path = f"{folder.rstrip('/')}/{extract_name(stamp)}"
    (gold.orderBy("year_month", "Actor1CountryCode", "Actor2CountryCode").coalesce(1)
     .write.mode("overwrite").option("header", "true").option("dateFormat", "yyyy-MM-dd").csv(path))
    return path
