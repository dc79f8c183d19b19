"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    ``row_number() = 1`` is planned with a partial group limit below the exchange, so each map
    task ships at most one row per key and a hot key costs no more than a cold one. ``order``
    must end in a unique column wherever the result has to be repeatable.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def newest_first(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def latest_refresh(df: DataFrame, date_column: str, before) -> DataFrame:
    """Rows of the newest refresh dated before ``before``.

    The newest date is an uncorrelated scalar subquery over one column; its value reaches the
    main scan as a filter, where ranking the whole table would pull it into a single task.
    """
    eligible = df.where(F.col(date_column) < F.lit(before))
    newest = eligible.agg(F.max(date_column))
    return df.where(F.col(date_column) == newest.scalar())


def collapse(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """One row per key with the greatest value of each column, to guard a lookup join."""
    return df.groupBy(key).agg(*[F.max(source).alias(name) for name, source in columns.items()])


def duplicated_keys(df: DataFrame, key: str, name: str = "ROW_COUNT") -> DataFrame:
    """Audit: keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
