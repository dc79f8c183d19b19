"""Line status of every account, present or recently departed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import flag
from sublens.load_date import LoadDate
from sublens.operators.joins import not_in, with_existence
from sublens.operators.latest import first_per_key, newest_first
from sublens.operators.latest_state import LatestState

DEPARTED_DAYS = 91


def eligible_snapshots(tables, load_date) -> DataFrame:
    """Snapshots of ordinary subscriptions; an unknown subscription type is dropped."""
    snapshots = tables.history("nobill_snapshot_subscription", load_date)
    return snapshots.where(~F.col("subscriptiontype").isin(decode.SPECIAL_SUBSCRIPTIONS))


def number_states(tables, load_date) -> DataFrame:
    """The snapshot of L-1 with its decoded blocked code and number status."""
    day = LoadDate.of(load_date)
    blocked = decode.blocked_label(F.col("blocked"))
    return (
        eligible_snapshots(tables, day)
        .where(F.col("snapshotdate") == F.lit(day.previous))
        .withColumn("blocked_status", blocked)
        .withColumn("number_status", decode.number_status(F.col("status"), F.col("blocked_status")))
    )


BLOCK_ORDER = ("localtstamp", "historytypekey", "additionalinfo")


def blocking_events(tables, load_date) -> DataFrame:
    return tables.history("nobill_tx_account_history", load_date).where(
        F.col("additionalinfo").isin(decode.BLOCKING_SERVICES)
    )


def latest_block(tables, load_date) -> DataFrame:
    """The newest blocking event per account, kept only if it put a block on.

    Removals take part in the ranking, so the filter has to follow it.
    """
    events = blocking_events(tables, load_date)
    newest = first_per_key(
        _ranked_block_columns(events),
        ["accountnum"],
        newest_first(*BLOCK_ORDER),
    )
    return newest.where(F.col("historytypekey") == decode.SERVICE_ADDED)


def latest_block_state(spark, name: str, folder: str, buckets: int = 200) -> LatestState:
    """The newest blocking event per account, kept in ``folder``."""
    return LatestState(spark, name, folder, ["accountnum"], BLOCK_ORDER, buckets)


def latest_block_from(tables, state: LatestState, load_date, before=None) -> DataFrame:
    """``latest_block`` from the state at an earlier load date and the events since; without one from all events."""
    day = LoadDate.of(load_date)
    events = blocking_events(tables, day)
    if before is None:
        rows = state.start(_ranked_block_columns(events), day.day)
    else:
        old = LoadDate.of(before)
        since = events.where(F.col("tstamp") >= F.lit(old.day).cast("timestamp_ntz"))
        rows = state.merge(_ranked_block_columns(since), old.day, day.day)
    return rows.where(F.col("historytypekey") == decode.SERVICE_ADDED)


def _ranked_block_columns(events: DataFrame) -> DataFrame:
    return events.select("accountnum", "additionalinfo", "historytypekey", "localtstamp")


def current_lines(tables, load_date) -> DataFrame:
    numbers = number_states(tables, load_date)
    blocks = latest_block(tables, load_date).select("accountnum", F.col("additionalinfo").alias("block_service"))
    status = decode.line_status(
        F.col("status"), F.col("blocked_status"), F.col("number_status"), F.col("block_service")
    )
    return numbers.join(blocks, "accountnum", "left").select(
        F.col("accountnum").alias("IN_ACCOUNT_NUMBER"), status.alias("STATUS")
    )


def departed_accounts(tables, load_date, days: int = DEPARTED_DAYS) -> DataFrame:
    """Accounts seen since L-days but not on L-1.

    One pass and one exchange: the test for L-1 is an aggregate next to the distinct.
    """
    day = LoadDate.of(load_date)
    seen = eligible_snapshots(tables, day).where(F.col("snapshotdate") >= F.lit(day.back(days)))
    return (
        seen.groupBy("accountnum")
        .agg(F.max(flag(F.col("snapshotdate") == F.lit(day.previous))).alias("present"))
        .where(F.col("present") == 0)
        .select("accountnum")
    )


def port_events(tables, load_date) -> DataFrame:
    """Number history before L with its port class."""
    day = LoadDate.of(load_date)
    history = tables["nobill_tx_phonenumber_history"]
    return history.where(
        (F.col("accountnum") > 1) & (F.col("tstamp") < F.lit(day.day).cast("timestamp_ntz"))
    ).withColumn("port_class", decode.port_class(F.col("historytypekey"), F.col("additionalinfo")))


def last_port_out(tables, load_date) -> DataFrame:
    events = port_events(tables, load_date).where(F.col("port_class") == "PORT-OUT")
    return events.groupBy("accountnum").agg(F.max("tstamp").alias("port_out_at"))


def ported_in(tables, load_date) -> DataFrame:
    events = port_events(tables, load_date).where(F.col("port_class") == "PORT-IN")
    return events.select("accountnum").distinct()


def departed_lines(tables, load_date, days: int = DEPARTED_DAYS) -> DataFrame:
    tagged = with_existence(
        departed_accounts(tables, load_date, days),
        last_port_out(tables, load_date),
        on="accountnum",
        name="STATUS",
        yes="PORT_OUT",
        no="TERMINATED",
    )
    return tagged.withColumnRenamed("accountnum", "IN_ACCOUNT_NUMBER")


def customer_base(tables, load_date, days: int = DEPARTED_DAYS) -> DataFrame:
    """(account, status) for accounts on L-1 and for those departed within the last ``days``."""
    return current_lines(tables, load_date).unionByName(departed_lines(tables, load_date, days))


def termination_date(tables, load_date, days: int = DEPARTED_DAYS) -> DataFrame:
    """When a departed account left: its port-out time, else the last day it was seen.

    "Departed" is a NOT IN here and a set difference in the customer base; the two differ as soon
    as an account is NULL, so they stay separate.
    """
    day = LoadDate.of(load_date)
    snapshots = eligible_snapshots(tables, day)
    recent = snapshots.where(F.col("snapshotdate") >= F.lit(day.back(days)))
    last_seen = recent.groupBy("accountnum").agg(F.max("snapshotdate").alias("last_seen"))
    present = snapshots.where(F.col("snapshotdate") == F.lit(day.previous)).select("accountnum")
    return (
        not_in(last_seen, "accountnum", present)
        .join(last_port_out(tables, load_date), "accountnum", "left")
        .select(
            F.col("accountnum").alias("IN_ACCOUNT_NUMBER"),
            F.coalesce(F.col("port_out_at"), F.col("last_seen").cast("timestamp_ntz")).alias(
                "TERMINATION_DATE"
            ),
        )
    )
