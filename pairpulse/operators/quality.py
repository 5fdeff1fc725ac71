"""One-pass quality reports.

A report is a DataFrame ``check_name STRING, violations BIGINT`` computed by a single
aggregation; :func:`enforce` reads its dozen rows and raises once with all failures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairpulse import schema
from pairpulse.functions.dates import Days

_INT_MAX = 2**31 - 1

# Reported, but no reason to stop: the row is kept and the field is NULL.
INFORMATIONAL = frozenset({"malformed_lines", "read_errors", "null_ids", "null_scores"})


class QualityError(ValueError):
    """A layer broke one of its rules; ``days`` are the days or months without rows, if it was that."""

    def __init__(self, message: str, days: Collection[dt.date] = ()) -> None:
        super().__init__(message)
        self.days = sorted(days)


def check_columns(df: DataFrame, expected: T.StructType, layer: str) -> None:
    """Names, order and types, from the plan alone."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in expected]
    if actual != wanted:
        raise QualityError(f"{layer} columns differ.\nExpected: {wanted}\nActual:   {actual}")


def _long(one_row: DataFrame) -> DataFrame:
    """One row of counts -> one row per count. ``explode`` of literals, no shuffle."""
    checks = F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("violations"))
        for c in one_row.columns])
    return one_row.select(F.inline(checks))


def _counts(checks: dict[str, Column]) -> list[Column]:
    return [F.coalesce(c, F.lit(0)).alias(n) for n, c in checks.items()]


def _empty(rows: Column) -> Column:
    return F.when(F.coalesce(rows, F.lit(0)) == 0, 1).otherwise(0)


def _extra(distinct: Column) -> Column:
    """Distinct values beyond the first."""
    return F.greatest(distinct - 1, F.lit(0))


def bronze_checks(columns: Collection[str], days: Days | None = None) -> dict[str, Column]:
    """Counts over bronze rows, by name. ``columns`` may hold the reader's diagnostics."""
    failed = (F.col(schema.READ_ERROR).isNotNull()
              if schema.READ_ERROR in columns else F.lit(False))
    line = ~failed
    checks = {
        "empty": _empty(F.count_if(line)),
        "null_file_dates": F.count_if(line & F.col("input_file_date").isNull()),
        "null_ids": F.count_if(line & F.col("GlobalEventID").isNull()),
    }
    if days is not None:
        checks["unexpected_file_dates"] = F.count_if(
            line & ~days.contains(F.col("input_file_date")))
    if schema.MALFORMED in columns:
        checks["malformed_lines"] = F.count_if(F.col(schema.MALFORMED))
    if schema.READ_ERROR in columns:
        checks["read_errors"] = F.count_if(failed)
    return checks


def line_dates(columns: Collection[str]) -> Column:
    """The file dates of bronze rows that are lines; NULL for one that is a read error."""
    date = F.col("input_file_date")
    return F.when(F.col(schema.READ_ERROR).isNull(), date) if schema.READ_ERROR in columns else date


def bronze_report(bronze: DataFrame, days: Days | None = None) -> DataFrame:
    """``bronze`` may carry the reader's diagnostics. With ``days`` every file date
    must be one of them, which also covers "one file date" for a single day."""
    checks = bronze_checks(bronze.columns, days) | {
        "extra_file_dates": _extra(F.count_distinct(line_dates(bronze.columns)))}
    return _long(bronze.agg(*_counts(checks)))


def _folded(silver: DataFrame) -> DataFrame:
    """Rows folded per (file date, id), which finds duplicates and combines on the map side."""
    return silver.groupBy("input_file_date", "GlobalEventID").agg(F.count(F.lit(1)).alias("copies"))


def _silver_checks(days: Days | None) -> dict[str, Column]:
    """Counts over folded rows."""
    checks = {
        "empty": _empty(F.sum("copies")),
        "extra_file_dates": _extra(F.count_distinct("input_file_date")),
        "duplicate_ids": F.count_if(F.col("copies") > 1),
        "null_ids": F.sum(F.when(F.col("GlobalEventID").isNull(), F.col("copies"))),
    }
    if days is not None:
        checks["unexpected_file_dates"] = F.sum(
            F.when(~days.contains(F.col("input_file_date")), F.col("copies")))
    return checks


def silver_report(silver: DataFrame, days: Days | None = None) -> DataFrame:
    """Rows are folded per (file date, id) first; everything else is counted on the folded rows."""
    return _long(_folded(silver).agg(*_counts(_silver_checks(days))))


def silver_counts(silver: DataFrame, days: Days) -> tuple[dict[str, int], set[dt.date]]:
    """The report of ``silver_report`` and the file dates that have rows, in one pass."""
    dates = F.collect_set("input_file_date").alias("file_dates")  # at most the days
    row = _folded(silver).agg(*_counts(_silver_checks(days)), dates).first().asDict()
    return row, set(row.pop("file_dates"))


def gold_checks() -> dict[str, Column]:
    """Range and consistency of the index, by name. NULL scores pass the range checks, as
    a NULL predicate does, and are counted on their own."""
    share, score = F.col("pol_involve_score"), F.col("suri_score")
    drift = F.abs(score - F.col("geo_unrest_score") * share)
    counts = [F.col(c) for c in schema.GOLD_COUNTS]
    return {
        "empty": _empty(F.count(F.lit(1))),
        "no_events": F.count_if(F.col("total_events") <= 0),
        "negative_unrest": F.count_if(F.col("geo_unrest_score") < 0),
        "involvement_out_of_range": F.count_if((share < 0) | (share > 1)),
        "negative_index": F.count_if(score < 0),
        "index_mismatch": F.count_if(drift > 0.01),
        "null_scores": F.count_if(share.isNull() | score.isNull()),
        "count_overflow": F.count_if(F.greatest(*counts) > _INT_MAX),
    }


def gold_report(gold: DataFrame) -> DataFrame:
    """The checks of ``gold_checks``, and that the rows are of one month."""
    checks = gold_checks() | {"extra_months": _extra(F.count_distinct("year_month"))}
    return _long(gold.agg(*_counts(checks)))


def enforce(report: DataFrame, layer: str, ignore: Collection[str] = ()) -> dict[str, int]:
    """Read the report (a fixed, small number of rows) and raise if a rule is broken."""
    return enforce_counts({r.check_name: r.violations for r in report.collect()}, layer, ignore)


def enforce_counts(found: dict[str, int], layer: str, ignore: Collection[str] = ()) -> dict[str, int]:
    """Raise once with all rules that are broken."""
    broken = {k: v for k, v in found.items()
              if v and k not in INFORMATIONAL and k not in ignore}
    if broken:
        raise QualityError(f"{layer}: " + ", ".join(f"{k}={v}" for k, v in sorted(broken.items())))
    return found
