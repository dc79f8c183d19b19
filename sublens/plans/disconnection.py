"""Blocking intervals, day-by-day line status, and the last disconnection of an account."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import latest
from sublens.load_date import LoadDate
from sublens.operators.carried_pairs import CarriedPairs
from sublens.operators.joins import interval_join
from sublens.operators.ordered import paired_in_order
from sublens.plans.customer_base import eligible_snapshots


_PAIR_KEYS = ["accountnum", "additionalinfo"]


def _block_changes(tables, load_date) -> DataFrame:
    return tables.history("nobill_tx_account_history", load_date).where(
        F.col("additionalinfo").isin(decode.BLOCKING_SERVICES)
        & F.col("historytypekey").isin(decode.SERVICE_ADDED, decode.SERVICE_REMOVED)
    )


def paired_blocks(tables, load_date) -> DataFrame:
    """(account, service, add, remove): the n-th add with the n-th remove, NULL while still open."""
    return paired_in_order(
        _block_changes(tables, load_date),
        keys=_PAIR_KEYS,
        at="tstamp",
        opens=F.col("historytypekey") == decode.SERVICE_ADDED,
        opened_at="add_date",
        closed_at="remove_date",
    )


def block_state(spark, folder: str) -> CarriedPairs:
    """Blocks paired so far, kept in ``folder``."""
    return CarriedPairs(spark, folder, _PAIR_KEYS, "add_date", "remove_date")


def paired_blocks_from(tables, state: CarriedPairs, load_date, before=None) -> DataFrame:
    """``paired_blocks`` from the state at an earlier load date and the changes since; without one from all."""
    day, added = LoadDate.of(load_date), F.col("historytypekey") == decode.SERVICE_ADDED
    changes = _block_changes(tables, day)
    if before is None:
        return state.start(changes, "tstamp", added, day.day)
    old = LoadDate.of(before)
    since = changes.where(F.col("tstamp") >= F.lit(old.day).cast("timestamp_ntz"))
    return state.advance(since, "tstamp", added, old.day, day.day)


def shown_until_load_date(pairs: DataFrame, load_date) -> DataFrame:
    """The blocks, those still open shown as lasting until L."""
    still_open = F.lit(LoadDate.of(load_date).day).cast("timestamp_ntz")
    return pairs.withColumn("remove_date", F.coalesce("remove_date", still_open))


def block_intervals(tables, load_date) -> DataFrame:
    """The blocks, those still open shown as lasting until L."""
    return shown_until_load_date(paired_blocks(tables, load_date), load_date)


def covering_blocks(tables, load_date) -> DataFrame:
    """The blocks with the moment until which they cover: an open one also covers the newest snapshot,
    which is tested at midnight of L."""
    day = LoadDate.of(load_date)
    return paired_blocks(tables, day).select(
        "accountnum",
        "additionalinfo",
        "add_date",
        F.coalesce("remove_date", F.lit(day.day).cast("timestamp_ntz")).alias("remove_date"),
        F.coalesce("remove_date", F.lit(day.back(-1)).cast("timestamp_ntz")).alias("covers_until"),
    )


def snapshots_with_blocks(tables, load_date) -> DataFrame:
    """Each snapshot with the blocks in force at the end of its day; overlapping blocks repeat it."""
    snapshots = eligible_snapshots(tables, load_date).select("accountnum", "snapshotdate", "status", "blocked")
    return interval_join(
        snapshots,
        covering_blocks(tables, load_date),
        on=["accountnum"],
        point=F.date_add("snapshotdate", 1).cast("timestamp_ntz"),
        start="add_date",
        end="covers_until",
    ).drop("covers_until")


def status_changes(tables, load_date) -> DataFrame:
    """Days on which the line status of an account differs from its previous day with a snapshot.

    Several snapshots or blocks on one day count as one state, the last by name, so that a blocked
    state wins over ACTIVE.
    """
    status = decode.snapshot_line_status(F.col("status"), F.col("blocked"), F.col("additionalinfo"))
    days = (
        snapshots_with_blocks(tables, load_date)
        .withColumn("line_status", status)
        .groupBy("accountnum", "snapshotdate")
        .agg(F.max("line_status").alias("line_status"))
    )
    # One row per account and calendar day from here on, so the window stays short for any account.
    by_day = Window.partitionBy("accountnum").orderBy("snapshotdate")
    stream = days.withColumns(
        {
            "prev_status": F.lag("line_status").over(by_day),
            "prev_status_date": F.lag("snapshotdate").over(by_day),
        }
    )
    first_ever = F.lit("2017-01-01").cast("date")
    return stream.withColumns(
        {
            "prev_status": F.coalesce("prev_status", F.lit("NA")),
            "prev_status_date": F.coalesce("prev_status_date", first_ever),
        }
    ).where(F.col("line_status") != F.col("prev_status"))


def disconnection_date(tables, load_date) -> DataFrame:
    """Latest day an account went from ACTIVE to a blocked or closed state.

    A line is ACTIVE exactly when its own codes say so and no block covers the day. Coverage is a
    running sum of block starts and ends, so snapshots and blocks meet in one aggregate per
    (account, day) instead of an interval join, and the final window sees at most one row per
    calendar day of an account.
    """
    open_line = (F.col("status") == decode.ACTIVE_LINE) & (F.col("blocked") == 0)
    snapshots = eligible_snapshots(tables, load_date).select(
        "accountnum",
        F.date_add("snapshotdate", 1).alias("moment"),
        F.coalesce(open_line, F.lit(False)).alias("open_line"),
        F.lit(0).alias("change"),
    )
    edges = covering_blocks(tables, load_date).select(
        "accountnum", _day_on_or_after("add_date").alias("from"), _day_on_or_after("covers_until").alias("to")
    )
    covering = F.col("accountnum").isNotNull() & (F.col("from") < F.col("to"))
    steps = edges.where(covering).select(
        "accountnum",
        F.inline(
            F.array(
                F.struct(F.col("from").alias("moment"), F.lit(1).alias("change")),
                F.struct(F.col("to").alias("moment"), F.lit(-1).alias("change")),
            )
        ),
    )
    days = (
        snapshots.unionByName(steps, allowMissingColumns=True)
        .groupBy("accountnum", "moment")
        .agg(F.min("open_line").alias("open_line"), F.sum("change").alias("change"))
    )
    by_day = Window.partitionBy("accountnum").orderBy("moment")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    active = F.when(
        F.col("open_line").isNotNull(), F.col("open_line") & (F.sum("change").over(so_far) == 0)
    )
    states = days.withColumn("active", active).withColumn(
        "was_active", F.last("active", ignorenulls=True).over(before)
    )
    dropped = F.col("was_active") & ~F.col("active")
    return (
        states.groupBy("accountnum")
        .agg(latest(dropped, F.date_sub("moment", 1)).alias("DISCONNECTION_DATE"))
        .where(F.col("DISCONNECTION_DATE").isNotNull())
        .withColumnRenamed("accountnum", "IN_ACCOUNT_NUMBER")
    )


def _day_on_or_after(column: str):
    """First midnight that is not before the timestamp."""
    midnight = F.to_date(column)
    return F.when(midnight.cast("timestamp_ntz") == F.col(column), midnight).otherwise(
        F.date_add(midnight, 1)
    )
