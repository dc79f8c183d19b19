"""Window totals carried from one load date to the next.

Two tables are kept under a folder: the sums of each day per key, partitioned by day, and the totals of each
load date per key, partitioned by load date. A new load date reads the fact for its new day only, adds the days
that enter each window to the totals of the load date before and takes off those that leave. A
partition is always written as a whole, so a step that is repeated gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.operators.rolling import Span


def _days(start: date, end: date) -> list[date]:
    return [start + timedelta(days=n) for n in range((end - start).days)]


def _in_any(on: str, days: Sequence[date]) -> Column:
    """Whether a day is one of some days, as ranges."""
    test, rest = F.lit(False), sorted(days)
    while rest:
        last = next((i for i in range(1, len(rest)) if rest[i] - rest[i - 1] > timedelta(days=1)), len(rest))
        test = test | F.col(on).between(F.lit(rest[0]), F.lit(rest[last - 1]))
        rest = rest[last:]
    return test


class DailyState:
    """Day sums and window totals per key in a folder.

    ``measures`` names the columns to be summed in each window, ``windows_of`` gives the half-open windows of a
    load date. ``rows`` names a measure that is positive on every row: a key stays in the totals of a load date
    as long as its sum over the window ``present`` is. Amounts must be whole numbers or decimals, so that
    what was added can be taken off exactly.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: Sequence[str],
        measures: Mapping[str, Sequence[str]],
        windows_of: Callable[[date], Mapping[str, Span]],
        present: str,
        rows: str = "rows",
    ):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._keys, self._measures, self._windows_of = list(keys), dict(measures), windows_of
        self._rows, self._present = rows, f"{rows}_{present}"
        if rows not in self._measures[present]:
            raise ValueError(f"window {present} must sum {rows}")

    def store_days(self, sums: DataFrame, on: str, days: Sequence[date]) -> None:
        """Store the sums of ``days`` in place of what is stored for them; a day without rows becomes empty."""
        wanted = sorted({m for names in self._measures.values() for m in names})
        rows = sums.where(_in_any(on, days)).select(*self._keys, *wanted, F.col(on).alias("day"))
        path = f"{self._folder}/days"
        # A row without figures for each day: a day that has no rows any more is written as well.
        marks = self._spark.createDataFrame([(day,) for day in days], "day date")
        rows.unionByName(marks, allowMissingColumns=True).repartition("day", *self._keys).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("day").parquet(path)

    def days(self) -> DataFrame:
        """The stored day sums; a filter on ``day`` only opens those partitions."""
        return self._spark.read.parquet(f"{self._folder}/days").where(F.col(self._rows).isNotNull())

    def totals(self, load_date: date) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/totals/load_date={load_date}")

    def start(self, load_date: date) -> DataFrame:
        """The totals of a load date from the stored days alone: for the first date, and after a late day."""
        windows = self._windows_of(load_date)
        held = {w: _days(start, end) for w, (start, end) in windows.items()}
        return self._stored(self._changes(held, {}), load_date)

    def advance(self, before: date, load_date: date) -> DataFrame:
        """The totals of a load date from those of an earlier one and the days in which their windows differ."""
        old, new = ({w: _days(*span) for w, span in self._windows_of(d).items()} for d in (before, load_date))
        enter = {w: sorted(set(new[w]) - set(old[w])) for w in new}
        leave = {w: sorted(set(old[w]) - set(new[w])) for w in new}
        changed = self.totals(before).unionByName(self._changes(enter, leave))
        names = [c for c in changed.columns if c not in self._keys]
        return self._stored(changed.groupBy(*self._keys).agg(*[F.sum(c).alias(c) for c in names]), load_date)

    def _changes(self, enter: Mapping[str, list[date]], leave: Mapping[str, list[date]]) -> DataFrame:
        """Per key, what the entering days add and the leaving days take off."""
        touched = {day for days in [*enter.values(), *leave.values()] for day in days}
        rows = self.days().where(_in_any("day", sorted(touched)))
        sums = []
        for window, names in self._measures.items():
            adds, takes = _in_any("day", enter[window]), _in_any("day", leave.get(window, []))
            for name in names:
                signed = F.when(adds, F.col(name)).when(takes, -F.col(name)).otherwise(0)
                sums.append(F.sum(signed).alias(f"{name}_{window}"))
        return rows.groupBy(*self._keys).agg(*sums)

    def _stored(self, totals: DataFrame, load_date: date) -> DataFrame:
        # Sums of sums would widen from date to date.
        kinds = {f.name: f.dataType for f in self.days().schema}
        columns = [F.col(k) for k in self._keys]
        for window, names in self._measures.items():
            for name in names:
                kind = kinds[name]
                if isinstance(kind, T.DecimalType):
                    kind = T.DecimalType(38, kind.scale)
                columns.append(F.col(f"{name}_{window}").cast(kind).alias(f"{name}_{window}"))
        kept = totals.where(F.col(self._present) > 0).select(*columns)
        kept.write.mode("overwrite").parquet(f"{self._folder}/totals/load_date={load_date}")
        return self.totals(load_date)
