"""Window totals for many load dates in one pass over a fact.

A report for one load date sums the days of its windows. Over a list of load dates a day enters a window at one
date of the list and leaves it at a later one, since both edges of a window move on with the load date. So
each day's sums are added where it enters and taken off where it leaves, and a running total along the list
gives every report: work grows with the days and not with days times load dates. Amounts are whole numbers or
decimals, so taking off what was added is exact.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A half-open window of days; without a start it reaches back to the first day there is.
Span = tuple[date | None, date]


class DateList:
    """Load dates in order, and at which of them a day is inside each window."""

    def __init__(self, dates: Sequence[date], windows_of: Callable[[date], Mapping[str, Span]]):
        self.dates = sorted(set(dates))
        if not self.dates:
            raise ValueError("no load dates")
        spans = [windows_of(day) for day in self.dates]
        self.names = list(spans[0])
        self.starts = {w: [s[w][0] for s in spans] for w in self.names}
        self.ends = {w: [s[w][1] for s in spans] for w in self.names}
        for w in self.names:
            for edges in (self.starts[w], self.ends[w]):
                known = [edge for edge in edges if edge is not None]
                if known != sorted(known) or len(known) not in (0, len(edges)):
                    raise ValueError(f"the edges of window {w} go back as the load date goes on")
        bounded = [edge for w in self.names for edge in [*self.starts[w], *self.ends[w]] if edge is not None]
        self.first, self.last = min([*bounded, self.dates[0]]), max([*bounded, self.dates[-1]])

    @property
    def scan(self) -> Span:
        """The days that any window of any load date holds."""
        starts = [self.starts[w][0] for w in self.names]
        return (None if None in starts else min(starts)), max(self.ends[w][-1] for w in self.names)

    def clamped(self, on: Column) -> Column:
        """The day, or one that stands for all days before or behind every edge; those take part in the same windows.

        Summed by it, a key has no more rows than there are days between the edges, however long its history is.
        """
        return F.least(F.greatest(on, F.lit(self.first - timedelta(days=1))), F.lit(self.last))

    def enters(self, window: str, on: Column) -> Column:
        """Place of the first load date whose window has its end behind the day."""
        return self._place(on, lambda day: bisect_right(self.ends[window], day))

    def leaves(self, window: str, on: Column) -> Column:
        """Place of the first load date whose window starts behind the day; their number if there is none."""
        if self.starts[window][0] is None:
            return F.lit(len(self.dates))
        return self._place(on, lambda day: bisect_right(self.starts[window], day))

    def after(self, known: Column) -> Column:
        """Place of the first load date later than a day."""
        return self._place(known, lambda day: bisect_right(self.dates, day))

    def _place(self, on: Column, at: Callable[[date], int]) -> Column:
        """``at`` of the day. Days before and after all edges share one value each."""
        days = [self.first + timedelta(days=n) for n in range(-1, (self.last - self.first).days + 1)]
        index = F.datediff(on, F.lit(days[0]))
        inside = F.least(F.greatest(index, F.lit(0)), F.lit(len(days) - 1))
        return F.get(F.lit([at(day) for day in days]), inside)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle by ``keys`` into a fixed number of partitions, which adaptive execution does not merge.

    It would merge by compressed bytes, which tell little of the memory that many wide sums per row take.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def totals_over_dates(
    days: DataFrame,
    keys: Sequence[str],
    on: str,
    measures: Mapping[str, Sequence[str]],
    dates: DateList,
    present: str,
    newest: tuple[str, str] | None = None,
    known: str | None = None,
) -> DataFrame:
    """Keys, load_date, ``<measure>_<window>`` for the measures of each window, and both columns of ``newest``.

    ``days`` holds sums per key and day ``on`` (or several rows of a day, which are added up). These narrow rows are
    shuffled by key, once: the wide sums per key and load date are made and run over in the same task.
    A key has a row for a load date if any of its rows lies in the window ``present``. ``newest`` names a value and its order, a
    number that grows with the day: the value of the last row in ``present`` is given.
    ``known`` names a day after which a row may first be seen: it counts from the next load date on.
    """
    n = len(dates.dates)
    seen = dates.after(F.col(known)) if known else F.lit(0)
    events = []
    for place, window in enumerate(dates.names):
        enters = F.greatest(dates.enters(window, F.col(on)), seen)
        leaves = dates.leaves(window, F.col(on))
        counts = enters < leaves
        for at, adds in ((enters, True), (leaves, False)):
            event = F.struct(at.alias("__at"), F.lit(place).alias("__window"), F.lit(adds).alias("__adds"))
            events.append(F.when(counts & (at < n), event))
    wanted = sorted({m for ms in measures.values() for m in ms})
    carried = list(newest or ())
    dealt = spread(days, *keys).select(*keys, *wanted, *carried, F.explode(F.array_compact(F.array(*events))).alias("__e")).select(
        *keys, *carried, "__e.*", *[F.when(F.col("__e.__adds"), F.col(m)).otherwise(-F.col(m)).alias(m) for m in wanted]
    )

    def inside(window: str) -> Column:
        return F.col("__window") == dates.names.index(window)

    cells = [(f"{m}_{w}", m, w) for w, ms in measures.items() for m in ms]
    sums = [F.sum(F.when(inside(w), F.col(m))).alias(name) for name, m, w in cells]
    sums.append(F.sum(F.when(inside(present), F.when(F.col("__adds"), 1).otherwise(-1))).alias("__rows"))
    if newest:
        value, order = newest
        entering = F.when(inside(present) & F.col("__adds"), F.col(order))
        sums += [F.max_by(value, entering).alias(value), F.max(entering).alias(order)]
    changes = dealt.groupBy(*keys, "__at").agg(*sums)
    # At most one row per load date of a key from here on.
    along = Window.partitionBy(*keys).orderBy("__at")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    running = [F.coalesce(F.sum(name).over(so_far), F.lit(0)).alias(name) for name, _, _ in cells]
    if newest:
        running += [F.max_by(value, order).over(so_far).alias(value), F.max(order).over(so_far).alias(order)]
    until = F.coalesce(F.lead("__at").over(along), F.lit(n))
    spans = changes.select(
        *keys, *running, F.sum("__rows").over(so_far).alias("__rows"), "__at", until.alias("__until")
    ).where(F.col("__rows") > 0)
    each = spans.withColumn("__place", F.explode(F.sequence(F.col("__at"), F.col("__until") - 1)))
    return each.select(
        *keys,
        F.get(F.array(*[F.lit(day) for day in dates.dates]), "__place").alias("load_date"),
        *[name for name, _, _ in cells],
        *carried,
    )


def following(points: DataFrame, marks: DataFrame, on: Sequence[str], at: str, mark: str) -> DataFrame:
    """``points`` with the first ``mark`` of their key that lies behind the day ``at``, NULL if none does.

    Both are stacked and walked backwards once, without a join. A key's rows under the window are its
    points and its distinct marks, so both should be one per key and day at most.
    """
    stacked = points.withColumn("__point", F.lit(True)).unionByName(
        marks.select(*on, F.col(mark).alias(at), F.col(mark)).withColumn("__point", F.lit(False)),
        allowMissingColumns=True,
    )
    # From the last day to the first; of one day the points come first and so do not see its mark.
    back = Window.partitionBy(*on).orderBy(F.desc(at), F.desc("__point")).rowsBetween(Window.unboundedPreceding, 0)
    found = stacked.withColumn(mark, F.min(mark).over(back))
    return found.where(F.col("__point")).drop("__point")
