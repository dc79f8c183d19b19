"""Usage of data, voice and SMS per account over rolling windows and calendar months; call counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions.decode import usage_tier
from sublens.functions.helpers import as_double, total
from sublens.load_date import LoadDate, within_closed
from sublens.operators.daily_state import DailyState
from sublens.operators.joins import not_in
from sublens.operators.latest import collapse
from sublens.operators.rolling import DateList, totals_over_dates

# Fixed values.
COUNTED_CATEGORIES = [0, 1]
ANSWERED = [0, 6, 7, 8, 10]
GIGABYTE = 1024.0**3
MINUTE = 60000.0
WINDOW_DAYS = 30
VOICE_SERVICE = 1
INCOMING, OUTGOING = 1, 2


def excluded_accounts(tables) -> DataFrame:
    tests = tables["nobill_dim_test_accounts"].where(
        (F.col("accountnum") != "") & (F.col("exclusion_flag") == "INCLUDE")
    )
    return tests.select("accountnum")


def _amounts() -> dict[str, Column]:
    """The additive amounts of a usage row by name."""
    amounts = {
        "received": F.col("ad_total_revenue_received") - F.col("ad_total_tax_amount"),
        "expired": F.col("ad_total_revenue_received_expired_bundle") - F.col("ad_total_tax_amount_expired_bundle"),
        "transferred": F.col("ad_total_revenue_received_transfer_bundle")
        - F.col("ad_total_tax_amount_transfer_bundle"),
    }
    plain = [
        "ad_total_revenue_net",
        "ad_total_duration",
        "ad_total_duration_payg",
        "ad_total_duration_counter",
        "ad_total_data_volume",
        "ad_total_data_volume_counter",
        "ad_total_data_volume_payg",
        "ad_total_counter_data_volume_transfer",
        "ad_total_sms",
        "ad_total_adjustment_amount",
    ]
    return amounts | {name: F.col(name) for name in plain}


def counted_usage(tables, start: date, end: date, per: Sequence[str] = ()) -> DataFrame:
    """Usage of ``[start, end]`` on counted counter types, summed per account and day, with service keys.

    The fact is summed by all that later tests look at before it meets a lookup, so what is shuffled
    for the lookups is a small part of it, and no counter type or transaction key is hot.
    """
    counters = tables["nobill_dim_counter_type"].where(
        F.col("dcr_category_8").try_cast("int").isin(COUNTED_CATEGORIES)
    )
    keys = tables["nobill_dim_transaction_key"].withColumnRenamed("transaction_id", "ad_transaction_id")
    keys_of_fact = ["ad_date", "ad_accountnum", "ad_counter_type_id", "ad_transaction_id", *per]
    summed = (
        tables["nobill_aggr_ws_cost_v3"]
        .where(within_closed(F.col("ad_date"), start, end))
        .groupBy(*keys_of_fact, F.col("ad_terminationreason").isin(ANSWERED).alias("answered"))
        .agg(*[F.sum(amount).alias(name) for name, amount in _amounts().items()])
    )
    return (
        summed.join(
            counters.select(
                F.col("dcr_counter_type_id").alias("ad_counter_type_id"),
                "dcr_category_2",
                "dcr_counter_type_name",
            ),
            "ad_counter_type_id",
        )
        .join(keys, "ad_transaction_id", "left")
    )


def without_test_accounts(per_account: DataFrame, tables, account: str) -> DataFrame:
    """Drop test accounts from rows that are already one per account, where the anti join is small."""
    text = per_account.withColumn("__account", F.col(account).cast("string"))
    return not_in(text, "__account", excluded_accounts(tables)).drop("__account")


def _service(group: str, kind: str | None = None, traffic: str | None = None) -> Column:
    test = F.col("service_group") == group
    if kind:
        test = test & (F.col("service_type") == kind)
    if traffic:
        test = test & (F.col("traffic_national_international") == traffic)
    return test


def minutes(kind: str, traffic: str | None = None) -> Column:
    """Test for answered voice traffic of a direction (MOC outgoing, MTC incoming)."""
    return _service("Voice", kind, traffic) & F.col("answered")


# Sums are taken over the whole numbers that the source holds (bytes, milliseconds) and turned
# into GB and minutes afterwards: exact, whatever the order in which rows arrive.
def gigabytes(total_bytes: Column) -> Column:
    return total_bytes / GIGABYTE


def as_minutes(milliseconds: Column) -> Column:
    return milliseconds / MINUTE


def core_metrics() -> dict[str, Column]:
    """The full set of daily measures as aggregates over ``counted_usage`` with event categories."""
    received, expired, transferred = F.col("received"), F.col("expired"), F.col("transferred")
    event_class = F.col("dev_category_3")
    duration = F.col("ad_total_duration")
    bundle_volume = F.col("ad_total_data_volume_counter")
    traffic_names = {"int": "International", "nat": "National", "roaming": "Roaming"}
    metrics = {"ad_total_revenue_net": as_double(F.sum("ad_total_revenue_net"))}

    def money(name: str, test: Column, amount: Column) -> None:
        metrics[name] = as_double(total(test, amount))

    for short, traffic in traffic_names.items():
        money(f"total_revenue_net_moc_voice_usage_{short}", _service("Voice", "MOC", traffic), received)
    money(
        "total_revenue_net_voice_expired_int",
        event_class.isin("Voice Plan Intl", "Voice Intl Booster"),
        expired,
    )
    money(
        "total_revenue_net_voice_upfront_int",
        _service("Voice") & (F.col("dev_event_name") == "Booster_IntlMin_Unlimited"),
        received,
    )
    money(
        "total_revenue_net_voice_expired_nat",
        event_class.isin("Voice Plan Natl", "Voice Natl Booster"),
        expired,
    )
    money("total_revenue_net_voice_expired_roaming", event_class == "Roaming Voice Bundle", expired)
    money("total_revenue_net_voice_expired", _service("Voice"), expired)
    money("total_revenue_net_data_usage_nat", _service("Data", None, "National"), received)
    money("total_revenue_net_expired_data_nat", event_class.isin("Data Plan", "Data Booster"), expired)
    money("total_revenue_net_transfer_data", _service("Data"), transferred)
    money("total_revenue_net_data_usage_roaming", _service("Data", None, "Roaming"), received)
    money("total_revenue_net_expired_data_roaming", event_class == "Roaming Data Bundle", expired)
    money("total_revenue_net_data_expired", _service("Data"), expired)
    money("total_revenue_net_sms", _service("SMS"), received)
    money("total_revenue_net_mtc", _service("Voice", "MTC"), received)
    for short, traffic in {"nat": "National", "intl": "International", "roaming": "Roaming"}.items():
        money(f"total_revenue_net_sms_{short}", _service("SMS", None, traffic), received)
        money(f"total_revenue_net_mtc_{short}", _service("Voice", "MTC", traffic), received)
        metrics[f"total_count_sms_{short}"] = total(_service("SMS", None, traffic), F.col("ad_total_sms"))
    metrics["total_count_sms"] = total(_service("SMS"), F.col("ad_total_sms"))
    for long, traffic in {"national": "National", "international": "International"}.items():
        out = minutes("MOC", traffic)
        bundled = out & (F.col("dcr_category_2") == "Voice Bundle")
        metrics[f"total_{long}_minutes_outgoing"] = as_minutes(total(out, duration))
        metrics[f"total_{long}_minutes_outgoing_pay"] = as_minutes(total(out, F.col("ad_total_duration_payg")))
        metrics[f"total_{long}_minutes_outgoing_bundle"] = as_minutes(
            total(bundled, F.col("ad_total_duration_counter"))
        )
    metrics["total_roaming_minutes_outgoing"] = as_minutes(total(minutes("MOC", "Roaming"), duration))
    metrics["total_mins_incoming"] = as_minutes(total(minutes("MTC"), duration))
    for long, traffic in {
        "national": "National",
        "international": "International",
        "roaming": "Roaming",
    }.items():
        metrics[f"total_{long}_minutes_incoming"] = as_minutes(total(minutes("MTC", traffic), duration))
    data = _service("Data")
    metrics["total_volume_data"] = gigabytes(total(data, F.col("ad_total_data_volume")))
    metrics["total_data_usage_national"] = gigabytes(total(_service("Data", None, "National"), bundle_volume))
    metrics["total_data_payg"] = gigabytes(total(data, F.col("ad_total_data_volume_payg")))
    metrics["total_data_usage_roaming"] = gigabytes(total(_service("Data", None, "Roaming"), bundle_volume))
    metrics["total_data_usage_bundle"] = gigabytes(
        total(data & (F.col("dcr_category_2") == "Data Bundle"), bundle_volume)
    )
    money("total_amount_recharge", _service("Recharge"), F.col("ad_total_adjustment_amount"))
    metrics["total_data_usage_transfer"] = gigabytes(
        total(
            F.col("dcr_counter_type_name") == "AC.Sender_DataCounter",
            F.col("ad_total_counter_data_volume_transfer"),
        )
    )
    return metrics


def daily_usage(tables, start, end) -> DataFrame:
    """All measures per account and day of ``[start, end]``, test accounts left out."""
    start, end = LoadDate.of(start).day, LoadDate.of(end).day
    events = collapse(
        tables["nobill_dim_event"],
        "dev_eventid_base",
        dev_category_1="dev_category_1",
        dev_category_3="dev_category_3",
        dev_event_name="dev_event_name",
    ).withColumnRenamed("dev_eventid_base", "ad_eventid")
    usage = counted_usage(tables, start, end, ["ad_eventid"]).join(events, "ad_eventid", "left")
    per_day = usage.groupBy("ad_date", F.col("ad_accountnum").alias("IN_ACCOUNT_NUMBER")).agg(
        *[column.alias(name) for name, column in core_metrics().items()]
    )
    return without_test_accounts(per_day, tables, "IN_ACCOUNT_NUMBER")


def usage_windows_of(load_date) -> dict[str, tuple[date, date]]:
    """Closed windows by label; rolling windows share their edge days, months are those of L itself,
    the current one up to L."""
    day = LoadDate.of(load_date)
    windows = {
        "30_days": (day.back(30), day.day),
        "30_60_days": (day.back(60), day.back(30)),
        "60_90_days": (day.back(90), day.back(60)),
    }
    for n in range(3):
        start, following = day.load_month(n)
        windows[f"M_{n}"] = (start, min(LoadDate(following).previous, day.day))
    return windows


def _measures() -> dict[str, tuple[Column, Column]]:
    """The sums behind the report columns: test and whole-number amount."""
    duration = F.col("ad_total_duration")
    return {
        "revenue": (F.lit(True), F.col("ad_total_revenue_net")),
        "bytes": (_service("Data"), F.col("ad_total_data_volume")),
        "national_out": (minutes("MOC", "National"), duration),
        "international_out": (minutes("MOC", "International"), duration),
        "roaming_out": (minutes("MOC", "Roaming"), duration),
        "national_in": (minutes("MTC", "National"), duration),
        "international_in": (minutes("MTC", "International"), duration),
        "roaming_in": (minutes("MTC", "Roaming"), duration),
    }


def windowed_usage(tables, windows: dict[str, tuple[date, date]]) -> DataFrame:
    """Per account, each measure summed over each closed window, in one scan of the fact.

    ``days_<window>`` tells in how many rows the account appears there; an account without any
    belongs to the table of another window only.
    """
    start = min(first for first, _ in windows.values())
    end = max(last for _, last in windows.values())
    measures = _measures()
    measured = counted_usage(tables, start, end).select(
        "ad_accountnum",
        "ad_date",
        *[F.when(test, amount).otherwise(0).alias(name) for name, (test, amount) in measures.items()],
    )
    sums = []
    for window, (first, last) in windows.items():
        inside = f"ad_date between date '{first}' and date '{last}'"
        sums.append(F.expr(f"count_if({inside}) as rows_{window}"))
        sums += [F.expr(f"sum(case when {inside} then {name} end) as {name}_{window}") for name in measures]
    per_account = measured.groupBy(F.col("ad_accountnum").alias("in_account_number")).agg(*sums)
    return without_test_accounts(per_account, tables, "in_account_number")


def _report(window: str) -> dict[str, Column]:
    """Report columns of one window by neutral name."""

    def m(name: str) -> Column:
        return F.col(f"{name}_{window}")

    volume = gigabytes(m("bytes"))
    return {
        "data": volume,
        "data_daily": volume / WINDOW_DAYS,
        "tier": usage_tier(volume),
        "national_out": as_minutes(m("national_out")),
        "international_out": as_minutes(m("international_out")),
        "roaming_out": as_minutes(m("roaming_out")),
        "roaming_in": as_minutes(m("roaming_in")),
        "national": as_minutes(m("national_out") + m("national_in")),
        "international": as_minutes(m("international_out") + m("international_in")),
        "arpu": as_double(m("revenue")) / WINDOW_DAYS,
        "all_out": as_minutes(m("national_out") + m("international_out") + m("roaming_out")),
    }


# Output columns of each window's table, by report column.
_ROLLING_COLUMNS = {
    "data": "DATA_USAGE_{w}",
    "national": "NATIONAL_VOICE_USAGE_{w}",
    "international": "INTERNATIONAL_VOICE_USAGE_{w}",
    "arpu": "Last_{w}_ARPU",
    "national_out": "Last_{w}_outgoing_national_voiceminutes",
}
_MONTH_COLUMNS = {
    "data": "DATA_USAGE_{w}",
    "national": "NATIONAL_VOICE_USAGE_{w}",
    "international": "INTERNATIONAL_VOICE_USAGE_{w}",
    "arpu": "ARPU_{w}",
}
USAGE_COLUMNS = {
    "30_days": {
        **_ROLLING_COLUMNS,
        "data_daily": "DATA_USAGE_30_DAY_AVG",
        "tier": "Last_30_days_data_usage",
        "international_out": "Last_30_days_outgoing_international_voiceminutes",
        "roaming_out": "Last_30_days_outgoing_roaming_voiceminutes",
        "roaming_in": "Last_30_days_incoming_roaming_voiceminutes",
        "all_out": "total_minutes_outgoing_30_days",
    },
    "30_60_days": {
        **_ROLLING_COLUMNS,
        "international_out": "Last_30_60_days_outgoing_international_voiceminutes",
        "all_out": "total_minutes_outgoing_30_60_days",
    },
    "60_90_days": _ROLLING_COLUMNS,
    "M_0": _MONTH_COLUMNS,
    "M_1": {
        **_MONTH_COLUMNS,
        "tier": "Last_month_data_usage",
        "national_out": "Last_month_outgoing_national_voiceminutes",
        "international_out": "Last_month_outgoing_international_voiceminutes",
        "roaming_out": "Last_month_outgoing_roaming_voiceminutes",
        "roaming_in": "Last_month_incoming_roaming_voiceminutes",
    },
    "M_2": _MONTH_COLUMNS,
}


def _columns(window: str) -> list[Column]:
    report = _report(window)
    return [report[r].alias(name.format(w=window)) for r, name in USAGE_COLUMNS[window].items()]


def usage_window(tables, load_date, window: str) -> DataFrame:
    """The table of one window, holding the accounts with usage in it."""
    edges = {window: usage_windows_of(load_date)[window]}
    return windowed_usage(tables, edges).select("in_account_number", *_columns(window))


def usage_all_windows(tables, load_date, labels: Sequence[str] = tuple(USAGE_COLUMNS)) -> DataFrame:
    """The labelled windows side by side from a single scan; NULL where an account has no usage."""
    every = usage_windows_of(load_date)
    windows = {label: every[label] for label in labels}
    return windowed_usage(tables, windows).select("in_account_number", *_side_by_side(list(windows)))


def _side_by_side(windows: Sequence[str]) -> list[Column]:
    columns = []
    for window in windows:
        used = F.col(f"rows_{window}") > 0
        report = _report(window)
        columns += [
            F.when(used, report[r]).alias(name.format(w=window))
            for r, name in USAGE_COLUMNS[window].items()
        ]
    return columns


def daily_measures(tables, start: date, end: date) -> DataFrame:
    """The report's measures per account and day of ``[start, end]``, without test accounts; ``rows`` is never 0."""
    measures = _measures()
    days = (
        counted_usage(tables, start, end)
        .groupBy("ad_accountnum", "ad_date")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.sum(F.when(test, amount).otherwise(0)).alias(name) for name, (test, amount) in measures.items()],
        )
    )
    return without_test_accounts(days, tables, "ad_accountnum")


def _half_open_windows(day: date) -> dict[str, tuple[date, date]]:
    closed = usage_windows_of(day)
    windows = {w: (first, LoadDate(last).back(-1)) for w, (first, last) in closed.items()}
    return {**windows, "scan": (min(s for s, _ in windows.values()), max(e for _, e in windows.values()))}


def usage_over_dates(tables, load_dates: Sequence) -> DataFrame:
    """``usage_all_windows`` of several load dates from one scan of the usage."""
    dates = DateList([LoadDate.of(d).day for d in load_dates], _half_open_windows)
    start, end = dates.scan
    totals = totals_over_dates(
        daily_measures(tables, start, LoadDate(end).previous),
        ["ad_accountnum"],
        "ad_date",
        {w: ["rows", *_measures()] for w in USAGE_COLUMNS},
        dates,
        present="scan",
    )
    return totals.select(
        "load_date", F.col("ad_accountnum").alias("in_account_number"), *_side_by_side(list(USAGE_COLUMNS))
    )


def usage_state(spark, folder: str) -> DailyState:
    """Day sums and window totals of the usage report, kept in ``folder``."""
    measures = {w: ["rows", *_measures()] for w in USAGE_COLUMNS} | {"scan": ["rows"]}
    return DailyState(spark, folder, ["ad_accountnum"], measures, _half_open_windows, present="scan")


def start_usage(tables, state: DailyState, load_date) -> DataFrame:
    """``usage_all_windows`` of the first load date of a state, which reads all days of its windows."""
    day = LoadDate.of(load_date)
    start, end = _half_open_windows(day.day)["scan"]
    _store_usage(tables, state, start, LoadDate(end).previous)
    return _state_report(state.start(day.day))


def advance_usage(tables, state: DailyState, before, load_date) -> DataFrame:
    """``usage_all_windows`` of a load date from the state at an earlier one; the fact is read for the days
    between them only. Test accounts are those known when a day is stored."""
    old, new = LoadDate.of(before), LoadDate.of(load_date)
    _store_usage(tables, state, old.back(-1), new.day)
    return _state_report(state.advance(old.day, new.day))


def restate_usage(tables, state: DailyState, late, load_date) -> DataFrame:
    """The report once more after rows of an earlier day came late: that day is stored anew, the totals come
    from the stored days."""
    day = LoadDate.of(late).day
    _store_usage(tables, state, day, day)
    return _state_report(state.start(LoadDate.of(load_date).day))


def _store_usage(tables, state: DailyState, start: date, end: date) -> None:
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    state.store_days(daily_measures(tables, start, end), "ad_date", days)


def _state_report(totals: DataFrame) -> DataFrame:
    return totals.select(F.col("ad_accountnum").alias("in_account_number"), *_side_by_side(list(USAGE_COLUMNS)))


def previous_day_usage(tables, load_date) -> DataFrame:
    """Data usage of the day L itself, whatever the column is called."""
    day = LoadDate.of(load_date)
    usage = windowed_usage(tables, {"day": (day.day, day.day)})
    return usage.select(
        "in_account_number", gigabytes(F.col("bytes_day")).alias("PREVIOUS_DAY_DATA_USAGE")
    )


def call_directions(tables, load_date) -> DataFrame:
    """Incoming and outgoing calls of 31 days and their ratio, 0 without incoming calls.

    A termination reason described more than once repeats its calls, so descriptions are counted
    per reason before the join.
    """
    day = LoadDate.of(load_date)
    calls = tables["nobill_fact_usage"].where(
        within_closed(F.to_date("fus_time_stamp"), day.back(WINDOW_DAYS), day.day)
        & (F.col("fus_service_type_id") == VOICE_SERVICE)
    )
    reasons = (
        tables["nobill_ref_terminationreason"]
        .where(F.col("fus_service_type_id") == VOICE_SERVICE)
        .groupBy("fus_terminationreason")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    termzones = tables["nobill_dim_termzone"].select(F.col("dtz_termzone_id").alias("fus_termzone_id"))
    origzones = tables["nobill_dim_origzone"].select(F.col("doz_origzone_id").alias("fus_origzone_id"))
    # Few distinct zones and reasons per account: counting first keeps any one of them from
    # drawing all its calls into one task should a lookup ever outgrow a broadcast join.
    counted = calls.groupBy(
        "fus_accountnum", "fus_termzone_id", "fus_origzone_id", "fus_terminationreason"
    ).agg(
        F.count_if(F.col("fus_call_direction_id") == INCOMING).alias("incoming"),
        F.count_if(F.col("fus_call_direction_id") == OUTGOING).alias("outgoing"),
    )
    times = F.coalesce("times", F.lit(1))
    per_account = (
        counted.join(termzones, "fus_termzone_id")
        .join(origzones, "fus_origzone_id")
        .join(reasons, "fus_terminationreason", "left")
        .groupBy(F.col("fus_accountnum").alias("account_number"))
        .agg(
            F.sum(F.col("incoming") * times).alias("incoming_count"),
            F.sum(F.col("outgoing") * times).alias("outgoing_count"),
        )
    )
    share = F.try_divide(as_double(F.col("outgoing_count")), as_double(F.col("incoming_count")))
    return per_account.withColumn(
        "INCOMING_OUTGOING_CALLS_PERC", F.when(F.col("incoming_count") > 0, share).otherwise(0.0)
    )
