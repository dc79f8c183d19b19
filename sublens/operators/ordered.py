"""Order-dependent work on keys of unbounded size.

A window over a key puts all its rows into one task. Here the key is first cut into buckets that
follow the order (a day, a block of ids), and rows only meet inside their bucket. What a bucket
has to know about the ones before it is one value per bucket, worked out from a small aggregate
and put in front of the bucket's rows as an extra row. The rows themselves are shuffled once, and
no join takes part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"
_IS_ROW = "__is_row"


def previous_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    previous: Mapping[str, str],
) -> DataFrame:
    """``lag(1)`` of some columns per key in ascending order; ``previous`` maps new name to column.

    ``bucket`` must not decrease along the order. In front of each bucket stands a copy of the
    last row of the key's bucket before it. With a single order column, never NULL, and columns of fixed width
    the last rows come from a hash aggregate; otherwise the whole table is sorted for them.
    """
    rows = df.withColumn(_BUCKET, bucket)
    sources = sorted(set(previous.values()) - set(keys))
    across = Window.partitionBy(*keys).orderBy(_BUCKET)
    if len(order) == 1:
        last_rows = rows.groupBy(*keys, _BUCKET).agg(*[F.max_by(c, order[0]).alias(c) for c in sources])
        fronts = last_rows.select(*keys, _BUCKET, *[F.lag(c).over(across).alias(c) for c in sources])
    else:
        last_rows = rows.groupBy(*keys, _BUCKET).agg(
            F.max_by(F.struct(*sources), F.struct(*order)).alias("__last")
        )
        fronts = last_rows.withColumn("__last", F.lag("__last").over(across)).select(
            *keys, _BUCKET, *[F.col(f"__last.{c}").alias(c) for c in sources]
        )
    return _behind_fronts(
        rows, fronts, keys, order, lambda window: {new: F.lag(c).over(window) for new, c in previous.items()}
    )


def numbered_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str
) -> DataFrame:
    """``row_number()`` per key in ascending order.

    In front of each bucket stands the number of rows in the key's buckets before it.
    """
    rows = df.withColumn(_BUCKET, bucket)
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    fronts = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, _BUCKET, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    )

    def number(window) -> dict[str, Column]:
        return {name: F.first("__offset").over(window) + F.row_number().over(window) - 1}

    return _behind_fronts(rows, fronts, keys, order, number).drop("__offset")


def paired_in_order(
    events: DataFrame, keys: Sequence[str], at: str, opens: Column, opened_at: str, closed_at: str
) -> DataFrame:
    """Pair the n-th opening of a key with its n-th closing; an unmatched opening is not closed (NULL).

    ``events`` holds openings (``opens`` true) and closings of the keys. Both are numbered in one
    go and meet by grouping on (key, number), which is spread evenly whatever the key. A missing
    key pairs with nothing.
    """
    marked = events.select(*keys, F.col(at).alias("__at"), opens.alias("__opens"))
    numbered = numbered_in_order(marked, [*keys, "__opens"], ["__at"], F.trunc("__at", "month"), "__n")
    whole_key = F.lit(True)
    for key in keys:
        whole_key = whole_key & F.col(key).isNotNull()
    pairs = numbered.groupBy(*keys, "__n").agg(
        F.max(F.when(F.col("__opens"), F.col("__at"))).alias(opened_at),
        F.max(F.when(~F.col("__opens") & whole_key, F.col("__at"))).alias(closed_at),
    )
    return pairs.where(F.col(opened_at).isNotNull()).drop("__n")


def _behind_fronts(rows: DataFrame, fronts: DataFrame, keys, order, computed) -> DataFrame:
    """Window columns over each bucket's front row followed by its rows; front rows are removed."""
    stacked = rows.withColumn(_IS_ROW, F.lit(True)).unionByName(
        fronts.withColumn(_IS_ROW, F.lit(False)), allowMissingColumns=True
    )
    window = Window.partitionBy(*keys, _BUCKET).orderBy(_IS_ROW, *order)
    return stacked.withColumns(computed(window)).where(F.col(_IS_ROW)).drop(_BUCKET, _IS_ROW)
