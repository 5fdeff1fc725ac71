"""Date arithmetic on columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The 14 digits of a slot, wherever they stand in the path of a landed file.
_SLOT_IN_PATH = r"(\d{14})\.export\.CSV"


@dataclass(frozen=True)
class Days:
    """Half-open range of days ``[start, end)`` without the days in ``skip``."""

    start: dt.date
    end: dt.date
    skip: frozenset[dt.date] = frozenset()

    @classmethod
    def one(cls, day: dt.date) -> Days:
        return cls(day, day + dt.timedelta(days=1))

    @classmethod
    def of(cls, days: Collection[dt.date]) -> Days:
        """The given days and no others."""
        first, last = min(days), max(days)
        every = {first + dt.timedelta(days=i) for i in range((last - first).days + 1)}
        return cls(first, last + dt.timedelta(days=1), frozenset(every - set(days)))

    def each(self) -> list[dt.date]:
        every = (self.start + dt.timedelta(days=i) for i in range((self.end - self.start).days))
        return [d for d in every if d not in self.skip]

    def without(self, days: Collection[dt.date]) -> Days:
        return Days(self.start, self.end, self.skip | frozenset(days))

    def _among(self, value: Column, render: Callable[[dt.date], object]) -> Column:
        """Membership as a range plus the shorter of the two lists of days."""
        hit = (value >= F.lit(render(self.start))) & (value < F.lit(render(self.end)))
        if not self.skip:
            return hit
        kept = self.each()
        if len(kept) < len(self.skip):
            return hit & value.isin([render(d) for d in kept])
        return hit & ~value.isin([render(d) for d in sorted(self.skip)])

    def contains(self, date: Column) -> Column:
        """Predicate that prunes partitions when ``date`` is a partition column."""
        return self._among(date, lambda d: d)

    def contains_digits(self, day: Column) -> Column:
        """The same for a day given as yyyyMMdd."""
        return self._among(day, lambda d: d.strftime("%Y%m%d"))


def event_date(day: Column) -> Column:
    """yyyyMMdd as an integer -> date; NULL for anything that is no date.

    Equal to parsing the eight digits with a pattern, but through the plain date cast,
    which is much cheaper. Fewer than eight digits turn into 10000000, which is no date
    (as does NULL); more than eight leave a part too long for the cast.
    """
    digits = F.greatest(day.cast("int"), F.lit(10000000)).cast("string")
    dashed = F.overlay(F.overlay(digits, F.lit("-"), 5, 0), F.lit("-"), 8, 0)
    return dashed.try_cast("date")


def month_of(date: Column) -> Column:
    """First day of the month."""
    return F.trunc(date, "month")


def days_in_month(date: Column) -> Column:
    return F.day(F.last_day(date))


def is_month_end(date: Column) -> Column:
    return date == F.last_day(date)


def within_months(date: Column, first: dt.date, end: dt.date) -> Column:
    """``first <= date < end`` for two firsts of a month; prunes partitions."""
    return (date >= F.lit(first)) & (date < F.lit(end))


def month_after(month: dt.date) -> dt.date:
    return (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def in_months(date: Column, months: Collection[dt.date]) -> Column:
    """``date`` lies in one of these months, given by their first days: one range for each
    run of months, which prunes and is pushed to scans as comparisons."""
    runs: list[list[dt.date]] = []
    for month in sorted(set(months)):
        if runs and runs[-1][1] == month:
            runs[-1][1] = month_after(month)
        else:
            runs.append([month, month_after(month)])
    return reduce(or_, [within_months(date, lo, hi) for lo, hi in runs]) if runs else F.lit(False)


def slot_digits(path: Column) -> Column:
    """yyyyMMddHHmmss of a landed file, the empty string for any other file."""
    return F.regexp_extract(path, _SLOT_IN_PATH, 1)


def file_date(path: Column) -> Column:
    """Date of a landed file."""
    return F.try_to_date(F.substring(slot_digits(path), 1, 8), "yyyyMMdd")


def path_in_days(path: Column, days: Days) -> Column:
    """File-level predicate. Comparing digits, not dates, keeps it deterministic and
    without a time zone, so the scan can apply it to the file listing."""
    return days.contains_digits(F.substring(slot_digits(path), 1, 8))
