"""The one parameter of every pipeline: the load date L.

All window edges are worked out here in Python, so that each one reaches the plan as a date
literal that Spark can push into the scan.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months(day: date, months: int) -> date:
    """Shift by whole months, clamping to the end of a shorter month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class LoadDate:
    day: date

    @classmethod
    def of(cls, value: LoadDate | date | str) -> LoadDate:
        if isinstance(value, LoadDate):
            return value
        return cls(date.fromisoformat(value) if isinstance(value, str) else value)

    def back(self, days: int) -> date:
        return self.day - timedelta(days=days)

    @property
    def previous(self) -> date:
        return self.back(1)

    def months_back(self, months: int, anchor: date | None = None) -> date:
        return add_months(anchor or self.day, -months)

    def month_start(self, months_ago: int = 0) -> date:
        """First day of the month of L-1, or of an earlier month."""
        return add_months(self.previous.replace(day=1), -months_ago)

    def load_month(self, months_ago: int = 0) -> tuple[date, date]:
        """The half-open calendar month of L itself (the usage family counts from L, not L-1)."""
        start = add_months(self.day.replace(day=1), -months_ago)
        return start, add_months(start, 1)


def within(col: Column, start: date | None, end: date | None) -> Column:
    """Half-open range ``[start, end)``; a missing edge is open."""
    tests = []
    if start is not None:
        tests.append(col >= F.lit(start))
    if end is not None:
        tests.append(col < F.lit(end))
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def within_closed(col: Column, start: date, end: date) -> Column:
    return (col >= F.lit(start)) & (col <= F.lit(end))
