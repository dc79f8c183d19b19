"""Distinct values per key over windows of days: as bits carried from day to day, and for many load dates at once.

A count of distinct values cannot be added up from day to day, but sets can be united. ``DailySets`` numbers the
values once and keeps, per key and day, the set of values as bits of 64-bit words; the set of a window is the
``bit_or`` of its days, a hash aggregate that is combined before its exchange however many rows a key has.
``distinct_over_dates`` needs no sets: a value counts from the load date at which one of its days enters the window
until its next day takes over, so plain sums give the counts.
"""

from __future__ import annotations

import calendar
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sublens.operators.rolling import DateList, Span

WORD = 64


def _month_of(day: date) -> date:
    return day.replace(day=1)


def _month_end(day: date) -> date:
    """The first day behind the month."""
    return _month_of(day) + timedelta(days=calendar.monthrange(day.year, day.month)[1])


def _pieces(span: Span, whole: set[date]) -> tuple[list[date], list[date]]:
    """A bounded half-open span as stored months that lie inside and the days left over."""
    day, end = span
    months, days = [], []
    while day < end:
        if day in whole and _month_end(day) <= end:
            months.append(day)
            day = _month_end(day)
        else:
            days.append(day)
            day += timedelta(days=1)
    return months, days


class DailySets:
    """Sets of values per key and day in a folder, united over the windows of a load date.

    Three tables are kept: the values with their numbers, which are never given anew; the sets of each day,
    partitioned by day; and the sets of each month that has ended, partitioned by month, so that a window of half a
    year opens some months and the days at its edges. A partition is always written as a whole, and new values are
    numbered before the sets that use them are written, so a step that is repeated gives the same sets. A day that
    is stored again, for late rows, takes its month with it.

    Values are codes from a list (networks, countries, products): their distinct list is gathered in one row to
    be numbered. NULL is no value; a NULL key is a key like others. Windows must have a start.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: Sequence[str],
        value: str,
        windows_of: Callable[[date], Mapping[str, Span]],
    ):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._keys, self._value, self._windows_of = list(keys), value, windows_of

    def store_days(self, rows: DataFrame, on: str, days: Sequence[date]) -> None:
        """Store the sets of ``days`` in place of what is stored for them; a day without rows becomes empty."""
        days = sorted(set(days))
        known = self._is_stored("values")
        of_days = rows.where(F.col(on).isin(days) & F.col(self._value).isNotNull()).select(
            *self._keys, F.col(self._value).alias("value"), F.col(on).alias("day")
        )
        self._number(of_days.select("value").distinct(), known)
        numbered = of_days.join(self.values(), "value")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % WORD).cast("int"))
        word = F.floor(F.col("number") / WORD).cast("int").alias("word")
        sets = numbered.groupBy("day", *self._keys, word).agg(F.bit_or(bit).alias("bits"))
        self._write(sets, "day", days, "days")
        newest = max(days)
        ended = sorted({_month_of(day) for day in days if _month_end(day) <= newest + timedelta(days=1)})
        held = {_month_of(day) for day in days} & self._whole_months()
        for month in sorted({*ended, *held}):
            of_month = self._stored("days").where((F.col("day") >= F.lit(month)) & (F.col("day") < F.lit(_month_end(month))))
            united = of_month.groupBy(F.lit(month).alias("month"), *self._keys, "word").agg(F.bit_or("bits").alias("bits"))
            self._write(united, "month", [month], "months")

    def values(self) -> DataFrame:
        """``value`` and its ``number``, from 0 on."""
        return self._spark.read.parquet(f"{self._folder}/values")

    def sets(self, load_date: date) -> DataFrame:
        """Keys, ``word`` and ``bits_<window>`` for the windows of a load date; 0 where a window is empty."""
        windows, whole = self._windows_of(load_date), self._whole_months()
        pieces = {w: _pieces(span, whole) for w, span in windows.items()}
        parts = []
        for table, unit, which in (("months", "month", 0), ("days", "day", 1)):
            touched = sorted({piece for both in pieces.values() for piece in both[which]})
            if not touched or not self._is_stored(table):
                continue
            bits = [F.when(F.col(unit).isin(both[which]), F.col("bits")).alias(f"bits_{w}") for w, both in pieces.items()]
            parts.append(self._stored(table).where(F.col(unit).isin(touched)).select(*self._keys, "word", *bits))
        if not parts:
            raise ValueError(f"no day is stored for the windows of {load_date}")
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        united = [F.coalesce(F.bit_or(f"bits_{w}"), F.lit(0).cast("long")).alias(f"bits_{w}") for w in windows]
        return rows.groupBy(*self._keys, "word").agg(*united)

    def counts(self, load_date: date) -> DataFrame:
        """Keys and ``n_<window>``, the number of distinct values in each window."""
        windows = self._windows_of(load_date)
        return self.sets(load_date).groupBy(*self._keys).agg(
            *[F.sum(F.bit_count(f"bits_{w}")).alias(f"n_{w}") for w in windows]
        )

    def members(self, load_date: date) -> DataFrame:
        """Keys, ``value`` and ``in_<window>``: a row for each value of a key in any window."""
        windows = list(self._windows_of(load_date))
        every = F.lit(0).cast("long")
        for w in windows:
            every = every.bitwiseOR(F.col(f"bits_{w}"))
        places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(F.col("__every"), i) == 1)
        each = self.sets(load_date).withColumn("__every", every).withColumn("__place", F.explode(places))
        held = [(F.getbit(F.col(f"bits_{w}"), F.col("__place")) == 1).alias(f"in_{w}") for w in windows]
        number = (F.col("word").cast("long") * WORD + F.col("__place")).alias("number")
        return each.select(*self._keys, number, *held).join(self.values(), "number").drop("number")

    def _number(self, found: DataFrame, known: bool) -> None:
        new, base = found, F.lit(0).cast("long")
        if known:
            new = found.join(self.values(), "value", "left_anti")
            base = self.values().agg((F.max("number") + 1).alias("base")).scalar()
        listed = new.agg(F.array_sort(F.collect_set("value")).alias("list"))
        numbers = listed.select(F.posexplode("list").alias("place", "value")).select(
            "value", (F.coalesce(base, F.lit(0).cast("long")) + F.col("place")).alias("number")
        )
        numbers.write.mode("append").parquet(f"{self._folder}/values")

    def _write(self, sets: DataFrame, unit: str, units: Sequence[date], table: str) -> None:
        # A row without a set for each unit: one that has no rows any more is written as well.
        marks = self._spark.createDataFrame([(u,) for u in units], f"{unit} date")
        sets.unionByName(marks, allowMissingColumns=True).repartition(unit, *self._keys).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(unit).parquet(f"{self._folder}/{table}")

    def _stored(self, table: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{table}").where(F.col("bits").isNotNull())

    def _is_stored(self, table: str) -> bool:
        """Whether a write of the table has ended: one that failed leaves neither files nor partitions in place."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{table}/{{part-*,*=*}}")
        found = path.getFileSystem(self._spark._jsc.hadoopConfiguration()).globStatus(path)
        return found is not None and len(found) > 0

    def _whole_months(self) -> set[date]:
        """The months that are stored; a list that grows by twelve a year."""
        if not self._is_stored("months"):
            return set()
        months = self._spark.read.parquet(f"{self._folder}/months").select("month").distinct()
        return {row["month"] for row in months.collect()}


def distinct_over_dates(
    days: DataFrame, keys: Sequence[str], value: str, on: str, dates: DateList
) -> DataFrame:
    """Keys, load_date and ``n_<window>``, the number of distinct values in each window of each load date.

    ``days`` may hold a key's value of a day several times; NULL values do not count. A key has a row for a load date
    if any window holds a value. A day of a value counts from the load date at which it enters a window
    until the value's next day enters it, or until it leaves: so a value is never counted twice, and each day
    makes at most two changes a window, however many load dates see it.
    """
    n = len(dates.dates)
    seen = days.where(F.col(value).isNotNull()).select(*keys, value, F.col(on).alias("__on")).distinct()
    # At most one row per day of a value from here on.
    following = F.lead("__on").over(Window.partitionBy(*keys, value).orderBy("__on"))
    seen = seen.withColumn("__next", following)
    events = []
    for place, window in enumerate(dates.names):
        taken_over = F.when(F.col("__next").isNotNull(), dates.enters(window, F.col("__next"))).otherwise(n)
        enters, ends = dates.enters(window, F.col("__on")), F.least(dates.leaves(window, F.col("__on")), taken_over)
        for at, step in ((enters, 1), (ends, -1)):
            event = F.struct(at.alias("__at"), F.lit(place).alias("__window"), F.lit(step).alias("__step"))
            events.append(F.when((enters < ends) & (at < n), event))
    dealt = seen.select(*keys, F.explode(F.array_compact(F.array(*events))).alias("__e")).select(*keys, "__e.*")

    def change(place: int) -> Column:
        return F.sum(F.when(F.col("__window") == place, F.col("__step")).otherwise(0))

    names = [f"n_{window}" for window in dates.names]
    changes = dealt.groupBy(*keys, "__at").agg(*[change(place).alias(name) for place, name in enumerate(names)])
    # At most one row per load date of a key from here on.
    along = Window.partitionBy(*keys).orderBy("__at")
    running = [F.sum(name).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(name) for name in names]
    until = F.coalesce(F.lead("__at").over(along), F.lit(n))
    spans = changes.select(*keys, *running, "__at", until.alias("__until")).where(
        F.greatest(*names, F.lit(0)) > 0
    )
    each = spans.withColumn("__place", F.explode(F.sequence(F.col("__at"), F.col("__until") - 1)))
    return each.select(
        *keys, F.get(F.array(*[F.lit(day) for day in dates.dates]), "__place").alias("load_date"), *names
    )
