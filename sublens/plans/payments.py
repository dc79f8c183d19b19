"""Payments, voucher redemptions and wallet recharges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import as_double, number_key, total, window_total
from sublens.load_date import LoadDate, within
from sublens.operators.rolling import DateList, following, totals_over_dates

# Fixed values.
VOUCHER_CHANNEL = "Voucher"
VOUCHER_ADJUSTMENT = "voucher"
VOUCHER_SCAN_DAYS = 180
RECENT_DAYS = 31
SCAN_DAYS = 91


def payment_windows(load_date) -> dict[str, tuple[date, date]]:
    """Half-open windows by output suffix; the first rolling window has 31 days."""
    day = LoadDate.of(load_date)
    return {
        "M_0": (day.month_start(), day.day),
        "M_1": (day.month_start(1), day.month_start()),
        "M_2": (day.month_start(2), day.month_start(1)),
        "last_30_days": (day.back(31), day.day),
        "last_31_60_days": (day.back(61), day.back(31)),
        "last_61_90_days": (day.back(91), day.back(61)),
    }


def number_intervals(tables, load_date) -> DataFrame:
    """From when to when an account held a number, where its activation falls into that time."""
    held = tables.history("nobill_snapshot_subscription", load_date).groupBy("phonenumber", "accountnum").agg(
        F.min("snapshotdate").alias("min_date"), F.max("snapshotdate").alias("max_date")
    )
    master = tables["customer_master"].select(
        number_key(F.col("IN_ACCOUNT_NUMBER")).alias("accountnum"),
        F.col("MSISDN").alias("phonenumber"),
        F.to_date("FULL_ACTIVATION_DATE").alias("activated"),
        F.col("CRM_UID").alias("Uid"),
    )
    return (
        held.join(master, ["accountnum", "phonenumber"])
        .where((F.col("activated") >= F.col("min_date")) & (F.col("activated") < F.col("max_date")))
        .drop("activated")
    )


def classified_payments(tables, load_date, days: int = SCAN_DAYS) -> DataFrame:
    """``payments_by_channel_id`` without the id."""
    return payments_by_channel_id(tables, load_date, days).drop("channel_id")


def payments_by_channel_id(tables, load_date, days: int = SCAN_DAYS) -> DataFrame:
    """Payments of the window with status and channel names, and how often each one counts.

    Every lookup is an inner join, so a payment without an error id, a method or a detail is
    dropped. A payment with several details counts once per detail; the details are counted
    before the join instead of repeating the payment.
    """
    day = LoadDate.of(load_date)
    payments = tables["payment_paymenttransactions"].where(
        within(F.col("CreationDate"), day.back(days), day.day)
    )
    states = tables["payment_paymentstatus"].select(F.col("ID").alias("StatusID"), "Status")
    channels = (
        tables["payment_paymentchannel"]
        .where(F.col("ChannelName") != VOUCHER_CHANNEL)
        .select(F.col("ID").alias("PaymentChannelID"), "ChannelName")
    )
    errors = tables["ref_payment_error"].select(F.col("payment_error_id").alias("ErrorID"))
    methods = tables["ref_payment_method"].select(F.col("payment_method_id").alias("PaymentMethodID"))
    services = tables["payment_servicetypes"].select(F.col("ID").alias("ServiceTypeID"))
    details = (
        tables["payment_paymentdetails"]
        .join(services, "ServiceTypeID")
        .groupBy(F.col("PaymentTransactionID").alias("ID"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return (
        payments.join(states, "StatusID")
        .join(channels, "PaymentChannelID")
        .join(errors, "ErrorID")
        .join(methods, "PaymentMethodID")
        .join(details, "ID")
        .select(
            "ID",
            "Uid",
            "CreationDate",
            F.to_date("CreationDate").alias("paid_on"),
            decode.payment_status(F.col("Status")).alias("status"),
            decode.payment_channel(F.col("ChannelName")).alias("channel"),
            F.col("PaymentChannelID").alias("channel_id"),
            (F.col("Amount") * F.col("times").cast("decimal(9,0)")).alias("amount"),
            "times",
        )
    )


def daily_payments(tables, load_date, days: int = SCAN_DAYS) -> DataFrame:
    """Payments per customer and day. A customer has at most 91 of these rows, however busy it is.

    The newest payment is told by a number made of its time and id, and keeps its channel as an id: both
    have a fixed width, so the aggregate stays a hash aggregate. The name is looked up at the end.
    """
    success, failed = F.col("status") == "Success", F.col("status") == "Failed"
    order = moment_and_id("CreationDate", "ID")
    return payments_by_channel_id(tables, load_date, days).groupBy("Uid", "paid_on").agg(
        total(success, F.col("amount")).alias("amount"),
        total(failed, F.col("times")).alias("failed"),
        F.max_by("channel_id", order).alias("channel_id"),
        F.max(order).alias("newest"),
    )


def moment_and_id(moment: str, number: str) -> Column:
    """One number that orders by a timestamp and then by a non-negative id."""
    micros = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz '1970-01-01', {moment})")
    room = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    return (micros.cast("decimal(18,0)") * room + F.col(number).cast("decimal(19,0)")).cast("decimal(38,0)")


def channel_names(tables) -> DataFrame:
    return tables["payment_paymentchannel"].select(
        F.col("ID").alias("channel_id"), decode.payment_channel(F.col("ChannelName")).alias("PAYMENT_METHOD")
    )


def _report_columns(windows: Sequence[str]) -> list[str]:
    return [
        *[f"PAYMENT_TOTAL_AMOUNT_{suffix}" for suffix in windows],
        *[f"PAYMENT_COUNT_FAILED_{suffix}" for suffix in windows],
    ]


def payments(tables, load_date) -> DataFrame:
    """Amounts paid, failed attempts and last method per account.

    The validity interval of a number only depends on the day of a payment, so payments are summed
    per customer and day first and only then meet the intervals.
    """
    day = LoadDate.of(load_date)
    on = F.col("paid_on")
    dated = daily_payments(tables, day).join(number_intervals(tables, day), "Uid").where(
        (on >= F.col("min_date")) & (on < F.col("max_date"))
    )
    windows = payment_windows(day)
    amounts = [
        as_double(window_total("paid_on", window, "amount")).alias(f"PAYMENT_TOTAL_AMOUNT_{suffix}")
        for suffix, window in windows.items()
    ]
    failures = [
        window_total("paid_on", window, "failed").alias(f"PAYMENT_COUNT_FAILED_{suffix}")
        for suffix, window in windows.items()
    ]
    return (
        dated.groupBy(F.col("accountnum").alias("IN_ACCOUNT_NUMBER"))
        .agg(*amounts, *failures, F.max_by("channel_id", "newest").alias("channel_id"))
        .join(channel_names(tables), "channel_id", "left")
        .select(
            F.lit(day.previous).alias("load_date"), "IN_ACCOUNT_NUMBER", *_report_columns(list(windows)), "PAYMENT_METHOD"
        )
    )


def _scanned_windows(day: date) -> dict[str, tuple[date, date]]:
    """The report's windows as far as its scan reaches, and the scan itself."""
    scan = (LoadDate(day).back(SCAN_DAYS), day)
    return {**{w: (max(start, scan[0]), end) for w, (start, end) in payment_windows(day).items()}, "scan": scan}


def payments_over_dates(tables, load_dates: Sequence) -> DataFrame:
    """``payments`` of several load dates from one scan of the payments.

    What differs between the dates besides the windows is until when a number is held: the interval
    ends with the newest snapshot before the load date. So a payment counts from the first load date behind
    the first snapshot that lies after both the payment and the activation.
    """
    dates = DateList([LoadDate.of(d).day for d in load_dates], _scanned_windows)
    first, last = LoadDate(dates.dates[0]), LoadDate(dates.dates[-1])
    on = F.col("paid_on")
    days = daily_payments(tables, last, SCAN_DAYS + (last.day - first.day).days)
    snapshots = tables.history("nobill_snapshot_subscription", last)
    held = snapshots.groupBy("phonenumber", "accountnum").agg(F.min("snapshotdate").alias("min_date"))
    master = tables["customer_master"].select(
        number_key(F.col("IN_ACCOUNT_NUMBER")).alias("accountnum"),
        F.col("MSISDN").alias("phonenumber"),
        F.to_date("FULL_ACTIVATION_DATE").alias("activated"),
        F.col("CRM_UID").alias("Uid"),
    )
    holders = held.join(master, ["accountnum", "phonenumber"]).where(F.col("activated") >= F.col("min_date"))
    dated = (
        days.join(holders, "Uid")
        .where(on >= F.col("min_date"))
        .withColumn("both", F.greatest(on, F.col("activated")))
        .drop("Uid", "min_date", "activated")
    )
    marks = (
        snapshots.where(F.col("snapshotdate") > F.lit(first.back(SCAN_DAYS)))
        .select("accountnum", "phonenumber", F.col("snapshotdate").alias("confirmed"))
        .distinct()
    )
    confirmed = following(dated, marks, ["accountnum", "phonenumber"], "both", "confirmed").where(
        F.col("confirmed").isNotNull()
    )
    windows = list(payment_windows(last))
    totals = totals_over_dates(
        confirmed,
        ["accountnum"],
        "paid_on",
        {w: ["amount", "failed"] for w in windows},
        dates,
        present="scan",
        newest=("channel_id", "newest"),
        known="confirmed",
    )
    return totals.join(channel_names(tables), "channel_id", "left").select(
        F.date_sub("load_date", 1).alias("load_date"),
        F.col("accountnum").alias("IN_ACCOUNT_NUMBER"),
        *[as_double(F.col(f"amount_{w}")).alias(f"PAYMENT_TOTAL_AMOUNT_{w}") for w in windows],
        *[F.col(f"failed_{w}").alias(f"PAYMENT_COUNT_FAILED_{w}") for w in windows],
        "PAYMENT_METHOD",
    )


def voucher_adjustments(tables, start: date, end: date) -> DataFrame:
    """Voucher rows of the adjustment fact in ``[start, end)``."""
    types = tables["nobill_dim_adjustment_type"].where(
        F.col("dad_adjustmenttypename") == VOUCHER_ADJUSTMENT
    )
    return (
        tables["nobill_fact_adjustment"]
        .where(within(F.col("fad_time_stamp"), start, end))
        .join(types.select(F.col("dad_adjustment_type_id").alias("fad_adjustment_type_id")), "fad_adjustment_type_id")
    )


def crm_accounts_per_account(tables, load_date) -> DataFrame:
    """How many CRM accounts name an account as theirs; each repeats the account's vouchers."""
    owner = tables.history("cas_tx_activations", load_date).groupBy("CRMAccountNo").agg(F.max("NobillAccountNo").alias("owned"))
    return owner.groupBy(number_key(F.col("owned")).alias("fad_accountnum")).agg(
        F.count(F.lit(1)).alias("times")
    )


def vouchers(tables, load_date) -> DataFrame:
    """Vouchers redeemed within 31 days, days since the last one and its amount.

    The account's vouchers are summed first and multiplied by its number of CRM accounts after
    that; the last voucher is one row and is not multiplied.
    """
    day = LoadDate.of(load_date)
    redeemed = voucher_adjustments(tables, day.back(VOUCHER_SCAN_DAYS), day.day)
    on, amount = F.to_date("fad_time_stamp"), F.col("fad_amount")
    recent = on >= F.lit(day.back(RECENT_DAYS))
    newest = F.max(F.struct(F.col("fad_time_stamp"), F.col("fad_vouchernum"), amount))
    per_account = redeemed.groupBy("fad_accountnum").agg(
        total(recent, amount).alias("value"),
        total(recent, F.lit(1)).alias("count"),
        newest.alias("newest"),
    )
    times = F.coalesce("times", F.lit(1))
    return per_account.join(crm_accounts_per_account(tables, day), "fad_accountnum", "left").select(
        F.lit(day.previous).alias("load_date"),
        F.col("fad_accountnum").alias("IN_ACCOUNT_NUMBER"),
        (as_double(F.col("value")) * times).alias("VOUCHERS_TOTAL_VALUE_REDEEMED"),
        (F.col("count") * times).alias("VOUCHERS_TOTAL_COUNT"),
        F.datediff(F.lit(day.day), F.to_date("newest.fad_time_stamp")).alias("VOUCHER_LAST_REDEMPTION_DATE"),
        as_double(F.col("newest.fad_amount")).alias("VOUCHER_LAST_REDEEMED_AMOUNT"),
    )


# Recharge columns by window.
RECHARGE_COLUMNS = {
    "M_0": "WALLET_RECHARGE_COUNT_M_0",
    "M_1": "WALLET_RECHARGE_COUNT_M_1",
    "last_30_days": "WALLET_RECHARGE_COUNT_last_30_days",
    "last_31_60_days": "_last_31_60_days",
    "last_61_90_days": "_last_61_90_days",
}


def wallet_recharges(tables, load_date) -> DataFrame:
    day = LoadDate.of(load_date)
    windows = payment_windows(day)
    return voucher_adjustments(tables, day.back(SCAN_DAYS), day.day).groupBy("fad_accountnum").agg(
        *[
            window_total("fad_time_stamp", windows[suffix], "1").alias(name)
            for suffix, name in RECHARGE_COLUMNS.items()
        ]
    )


def wallet_recharges_over_dates(tables, load_dates: Sequence) -> DataFrame:
    """``wallet_recharges`` of several load dates L, given as ``load_date``, from one scan."""
    dates = DateList([LoadDate.of(d).day for d in load_dates], _scanned_windows)
    days = (
        voucher_adjustments(tables, *dates.scan)
        .groupBy("fad_accountnum", F.to_date("fad_time_stamp").alias("on"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    totals = totals_over_dates(
        days, ["fad_accountnum"], "on", {w: ["times"] for w in RECHARGE_COLUMNS}, dates, present="scan"
    )
    return totals.select(
        "load_date", "fad_accountnum", *[F.col(f"times_{w}").alias(name) for w, name in RECHARGE_COLUMNS.items()]
    )
