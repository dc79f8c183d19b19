"""Booster purchases: counts by window and kind, and a purchase profile per kind."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions.decode import purchase_profile
from sublens.functions.helpers import as_double, flag, latest, total, window_total
from sublens.load_date import LoadDate, within
from sublens.operators.rolling import DateList, spread, totals_over_dates

# Fixed values.
EVENT_GROUPS = ["Booster", "Roaming"]
KINDS = {"NATL": "VOICE_LCL", "INTL": "VOICE_INT", "DATA": "DATA"}
SCAN_DAYS = 92
NO_DATE = date(1900, 1, 1)

# Output columns in report order. Names not computed below are placeholders.
BOOSTER_COLUMNS = """
IN_ACCOUNT_NUMBER
BOOSTER_TOTAL_NATL_COUNT_M0 BOOSTER_TOTAL_NATL_COUNT_M1 BOOSTER_TOTAL_NATL_COUNT_M2
BOOSTER_TOTAL_INTL_COUNT_M0 BOOSTER_TOTAL_INTL_COUNT_M1 BOOSTER_TOTAL_INTL_COUNT_M2
BOOSTER_TOTAL_DATA_COUNT_M0 BOOSTER_TOTAL_DATA_COUNT_M1 BOOSTER_TOTAL_DATA_COUNT_M2
BOOSTER_PURCHASE_PROFILE_DATA BOOSTER_PURCHASE_PROFILE_NATL BOOSTER_PURCHASE_PROFILE_INTL
BOOSTER_TOTAL_DATA_COUNT BOOSTER_TOTAL_NATL_COUNT BOOSTER_TOTAL_INTL_COUNT
BOOSTER_NATL_EXPIRATION_DATE BOOSTER_INTL_EXPIRATION_DATE BOOSTER_DATA_EXPIRATION_DATE
BOOSTER_PURCHASE_PROFILE_ANY BOOSTER_COLUMN_01 BOOSTER_COLUMN_02 BOOSTER_COLUMN_03
BOOSTER_TOTAL_NATL_COUNT_LAST_7DAYS BOOSTER_TOTAL_INTL_COUNT_LAST_7DAYS
BOOSTER_TOTAL_DATA_COUNT_LAST_7DAYS
FIRST_TIME_BOOSTER_ANY_INLIFE FIRST_TIME_BOOSTER_DATA_INLIFE FIRST_TIME_BOOSTER_NATL_INLIFE
FIRST_TIME_BOOSTER_INTL_INLIFE FIRST_TIME_BOOSTER_VOICE_ROAMING_INLIFE
BOOSTER_TOTAL_NATL_COUNT_LAST_30DAYS BOOSTER_TOTAL_NATL_COUNT_LAST_31_60DAYS
BOOSTER_TOTAL_NATL_COUNT_LAST_61_90DAYS
BOOSTER_TOTAL_INTL_COUNT_LAST_30DAYS BOOSTER_TOTAL_INTL_COUNT_LAST_31_60DAYS
BOOSTER_TOTAL_INTL_COUNT_LAST_61_90DAYS
BOOSTER_TOTAL_DATA_COUNT_LAST_30DAYS BOOSTER_TOTAL_DATA_COUNT_LAST_31_60DAYS
BOOSTER_TOTAL_DATA_COUNT_LAST_61_90DAYS
""".split()
ZERO_PLACEHOLDERS = ["BOOSTER_TOTAL_DATA_COUNT", "BOOSTER_TOTAL_NATL_COUNT", "BOOSTER_TOTAL_INTL_COUNT"]
BLANK_PLACEHOLDERS = ["BOOSTER_PURCHASE_PROFILE_ANY", "BOOSTER_COLUMN_01", "BOOSTER_COLUMN_02", "BOOSTER_COLUMN_03"]


def purchase_windows(load_date) -> dict[str, tuple[date, date]]:
    """Half-open date windows by output suffix; months are calendar months counted from L-1."""
    day = LoadDate.of(load_date)
    return {
        "LAST_7DAYS": (day.back(7), day.day),
        "LAST_30DAYS": (day.back(30), day.day),
        "LAST_31_60DAYS": (day.back(60), day.back(30)),
        "LAST_61_90DAYS": (day.back(90), day.back(60)),
        "M0": (day.month_start(), day.day),
        "M1": (day.month_start(1), day.month_start()),
        "M2": (day.month_start(2), day.month_start(1)),
    }


def kinds_per_event(tables) -> DataFrame:
    """Per event id, how many service-file rows name each kind; repeats then count as repeats."""
    kind = F.col("EXCEL_SERVICE_TYPE")
    return tables["po_service_file"].groupBy(F.col("EXCEL_SERVICE_EVENT_ID").alias("EVENT_IN_EVENT_ID")).agg(
        *[F.sum(flag(kind == name)).alias(f"rows_{label}") for label, name in KINDS.items()]
    )


def _times(amount: Column, rows: str) -> Column:
    """Exact product of an amount and a number of rows; a wider count would cost decimals."""
    return amount.cast("decimal(28,10)") * F.coalesce(rows, F.lit(0)).cast("decimal(9,0)")


def booster_events(tables, load_date, dates: DateList | None = None) -> DataFrame:
    """Booster and roaming events before L per account, day and kind, with their quantity by both ways of
    counting: ``quantity`` goes by the event's own service type, ``filed_<kind>`` by the service file.
    With ``dates``, days that no window of any load date tells apart are one day."""
    day = LoadDate.of(load_date)
    on = F.col("EVENT_IN_DATE")
    booster = F.col("EVENT_IN_EVENT_GROUP") == "Booster"
    quantity = F.when(booster, F.col("quantity")).otherwise(0)
    # summed by all that is looked at before the lookup, so that no event id is hot
    summed = (
        tables.history("event_in_booster", day)
        .where(F.col("EVENT_IN_EVENT_GROUP").isin(EVENT_GROUPS))
        .groupBy(
            "EVENT_IN_ACCOUNT_NUMBER",
            (dates.clamped(on) if dates else on).alias("event_date"),
            "EVENT_IN_EVENT_ID",
            "EVENT_IN_EVENT_GROUP",
            "EVENT_IN_SERVICE_TYPE",
        )
        .agg(F.sum("EVENT_IN_TOTAL_QUANTITY").alias("quantity"))
    )
    return (
        summed.join(kinds_per_event(tables), "EVENT_IN_EVENT_ID", "left")
        .select(
            F.col("EVENT_IN_ACCOUNT_NUMBER").alias("IN_ACCOUNT_NUMBER"),
            "event_date",
            F.when(booster, F.col("EVENT_IN_SERVICE_TYPE")).alias("kind"),
            quantity.alias("quantity"),
            *[_times(quantity, f"rows_{label}").alias(f"filed_{label}") for label in KINDS],
        )
    )


def booster_counts(tables, load_date) -> DataFrame:
    """In-life totals, last dates and window counts per account in one pass over the fact.

    In-life figures go by the event's own service type, window figures by the service file. The
    window counts are NULL for an account without any booster or roaming event in the last 92 days.
    """
    day = LoadDate.of(load_date)
    events = booster_events(tables, day)
    on = F.col("event_date")
    seen_lately = F.max(flag(within(on, day.back(SCAN_DAYS), day.day))) == 1
    aggregates = []
    for label, name in KINDS.items():
        kind = F.col("kind") == name
        aggregates += [
            as_double(total(kind, F.col("quantity"))).alias(f"TOTAL_{label}_BOOSTER_QTY"),
            latest(kind, on).alias(f"LAST_{label}_BOOSTER_DATE"),
            as_double(total(kind & (on < F.lit(day.back(30))), F.col("quantity"))).alias(
                f"TOTAL_{label}_BOOSTER_BEFORE30D_QTY"
            ),
        ]
        for suffix, window in purchase_windows(day).items():
            count = as_double(window_total("event_date", window, f"filed_{label}"))
            aggregates.append(
                F.when(seen_lately, count).alias(f"BOOSTER_TOTAL_{label}_COUNT_{suffix}")
            )
    return events.groupBy("IN_ACCOUNT_NUMBER").agg(*aggregates)


def booster_purchases(tables, load_date, blank_placeholders: bool = False) -> DataFrame:
    """The report; its placeholder columns are typed, or all empty text for consumers that want that."""
    counts = booster_counts(tables, load_date)
    return counts.select(*_report(counts.columns, blank_placeholders))


def _report(columns: Sequence[str], blank_placeholders: bool = False) -> list[Column]:
    profiles = {
        f"BOOSTER_PURCHASE_PROFILE_{label}": purchase_profile(
            F.col(f"TOTAL_{label}_BOOSTER_QTY"),
            F.col(f"BOOSTER_TOTAL_{label}_COUNT_LAST_30DAYS"),
            F.col(f"BOOSTER_TOTAL_{label}_COUNT_LAST_31_60DAYS"),
            F.col(f"TOTAL_{label}_BOOSTER_BEFORE30D_QTY"),
        )
        for label in KINDS
    }
    available = {**{c: F.col(c) for c in columns}, **profiles}

    def placeholder(name: str):
        if blank_placeholders or name in BLANK_PLACEHOLDERS:
            return F.lit("")
        return F.lit(0) if name in ZERO_PLACEHOLDERS else F.lit(NO_DATE)

    return [available.get(name, placeholder(name)).alias(name) for name in BOOSTER_COLUMNS]


def _dated_windows(day: date) -> dict[str, tuple[date | None, date]]:
    load = LoadDate(day)
    return {
        **purchase_windows(load),
        "life": (None, day),
        "before": (None, load.back(30)),
        "lately": (load.back(SCAN_DAYS), day),
    }


def booster_purchases_over_dates(tables, load_dates: Sequence) -> DataFrame:
    """``booster_purchases`` of several load dates L, given as ``load_date``, from one scan of the events."""
    dates = DateList([LoadDate.of(d).day for d in load_dates], _dated_windows)
    own = [
        total(F.col("kind") == name, F.col("quantity")).alias(f"own_{label}") for label, name in KINDS.items()
    ]
    filed = [F.sum(f"filed_{label}").alias(f"filed_{label}") for label in KINDS]
    days = (
        spread(booster_events(tables, dates.dates[-1], dates), "IN_ACCOUNT_NUMBER", "event_date")
        .groupBy("IN_ACCOUNT_NUMBER", "event_date")
        .agg(F.count(F.lit(1)).alias("events"), *own, *filed)
    )
    kinds, windows = list(KINDS), list(purchase_windows(dates.dates[-1]))
    measures = {w: [f"filed_{label}" for label in kinds] for w in windows}
    measures |= {w: [f"own_{label}" for label in kinds] for w in ("life", "before")} | {"lately": ["events"]}
    totals = totals_over_dates(days, ["IN_ACCOUNT_NUMBER"], "event_date", measures, dates, present="life")
    counts = {}
    for label in kinds:
        counts[f"TOTAL_{label}_BOOSTER_QTY"] = as_double(F.col(f"own_{label}_life"))
        counts[f"TOTAL_{label}_BOOSTER_BEFORE30D_QTY"] = as_double(F.col(f"own_{label}_before"))
        for window in windows:
            counts[f"BOOSTER_TOTAL_{label}_COUNT_{window}"] = F.when(
                F.col("events_lately") > 0, as_double(F.col(f"filed_{label}_{window}"))
            )
    named = totals.select("IN_ACCOUNT_NUMBER", "load_date", *[c.alias(name) for name, c in counts.items()])
    return named.select("load_date", *_report(named.columns))
