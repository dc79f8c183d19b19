"""Joins with warehouse semantics: NOT IN, existence flags, repeated rows, point in interval.

No broadcast is forced anywhere. Spark compares each side's size with
``spark.sql.autoBroadcastJoinThreshold`` at planning time and again, through adaptive execution,
with the measured size at run time; a side beyond it takes the sort-merge route.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``column NOT IN (keys)`` with SQL's three-valued logic, as an ordinary hash-partitioned anti join.

    A NULL among the keys empties the result, and a NULL on the left is only kept when there are
    no keys at all. Both facts are one-value scalar subqueries, so nothing has to be broadcast.
    """
    (key,) = keys.columns
    census = keys.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(key).isNull()).alias("nulls"),
        ).alias("census")
    ).scalar()
    allowed = (census["nulls"] == 0) & (F.col(column).isNotNull() | (census["rows"] == 0))
    return df.where(allowed).join(keys.select(F.col(key).alias(column)), column, "left_anti")


def with_existence(df: DataFrame, keys: DataFrame, on: str, name: str, yes, no) -> DataFrame:
    """Add ``yes`` where the key occurs in ``keys`` and ``no`` elsewhere; never repeats a row."""
    marked = keys.select(on).distinct().withColumn("__seen", F.lit(True))
    return df.join(marked, on, "left").withColumn(
        name, F.when(F.col("__seen"), yes).otherwise(no)
    ).drop("__seen")


def repeat_rows(df: DataFrame, times: str, block: int = 4096, by: Sequence[str] = ()) -> DataFrame:
    """Repeat each row ``times`` times (NULL counts as once) and drop that column.

    A row is first split into blocks of copies, and the blocks are dealt over all tasks before their copies are
    made: a row that has to be repeated millions of times is the work of many tasks, and no generated array
    is large. What is shuffled are blocks, not copies. ``by`` names columns that tell rows apart well enough to
    deal them, by default all.
    """
    n = F.coalesce(F.col(times), F.lit(1)).cast("bigint")
    blocks = df.withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / block)))
    )
    # A fixed number of partitions, which adaptive execution does not merge: blocks are small but mean work.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(tasks, *[F.col(f"`{c}`") for c in ([*by, "__block"] if by else blocks.columns)])
    size = F.least(F.lit(block).cast("bigint"), n - F.col("__block") * block)
    return dealt.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))
    ).drop("__block", "__copy", times)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: Column,
    start: str,
    end: str,
    how: str = "left",
    bucket_days: int = 32,
    levels: int = 8,
) -> DataFrame:
    """Join each point to the intervals ``[start, end)`` of its key that hold it.

    Time is cut into buckets of ``bucket_days``, and the buckets that an interval touches into the fewest aligned
    blocks of 1, 2, 4 .. 2**levels buckets: at most two of each size, and as many of the largest as a
    longer interval needs. A bucket lies in one block of every size, hence in one block of an interval at
    most, so a point asks once per size that occurs and no pair is found twice. Only distinct points ask, without the rest of their rows; what they find goes
    back to the rows by key and point. All joins have the block or the point in their key, which spreads a
    key with many of either.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no {how} join of points")
    valid = intervals.where(F.col(start) < F.col(end))

    def bucket(moment: Column) -> Column:
        days = F.datediff(F.to_date(moment), F.lit("1970-01-01").cast("date"))
        return F.floor(days / bucket_days).cast("int")

    blocks = aligned_blocks(bucket(F.col(start)), bucket(F.col(end)) + 1, levels)
    cut = valid.select(*intervals.columns, F.inline(blocks))
    sizes = cut.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("__level")))).scalar()
    tagged = points.withColumn("__point", point)
    known = F.col("__point").isNotNull()
    for key in on:
        known = known & F.col(key).isNotNull()
    asked = tagged.where(known).select(*on, "__point").distinct()
    asking = (
        asked.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
        .where(F.getbit(sizes, F.col("__level")) == 1)
        .withColumn("__block", F.call_function("shiftright", bucket(F.col("__point")), F.col("__level")))
    )
    found = asking.join(cut, [*on, "__level", "__block"]).where(
        (F.col("__point") >= F.col(start)) & (F.col("__point") < F.col(end))
    )
    others = [c for c in intervals.columns if c not in on]
    left, right = tagged.alias("p"), found.select(*on, "__point", *others).alias("i")
    same = F.col("p.__point") == F.col("i.__point")
    for key in on:
        same = same & (F.col(f"p.{key}") == F.col(f"i.{key}"))
    return left.join(right, same, how).select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in others])


def aligned_blocks(first: Column, behind: Column, levels: int) -> Column:
    """The aligned blocks that make up the whole numbers ``first`` to ``behind`` (exclusive): array of (__level,
    __block), block b of level k holding b * 2**k to (b + 1) * 2**k."""

    def up(k: Column) -> Column:
        return -F.call_function("shiftright", -first, k)

    def down(k: Column) -> Column:
        return F.call_function("shiftright", behind, k)

    def block(k: Column, number: Column) -> Column:
        return F.struct(k.alias("__level"), number.alias("__block"))

    def edges(k: Column) -> Column:
        odd_first, odd_behind = F.pmod(up(k), F.lit(2)) == 1, F.pmod(down(k), F.lit(2)) == 1
        ahead = F.when(odd_first & (up(k) < down(k)), block(k, up(k)))
        rest = up(k) + F.when(odd_first, 1).otherwise(0)
        return F.array_compact(F.array(ahead, F.when(odd_behind & (rest < down(k)), block(k, down(k) - 1))))

    top = F.lit(levels)
    none = F.array().cast("array<struct<__level:int,__block:int>>")
    smaller = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), edges)) if levels else none
    largest = F.when(
        up(top) < down(top), F.transform(F.sequence(up(top), down(top) - 1), lambda number: block(top, number))
    )
    return F.concat(smaller, F.coalesce(largest, none))
