"""Value-added services, boosters and roaming bundles: the event-action history of an account."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import (
    as_double,
    days_since,
    days_until,
    earliest,
    flag,
    latest,
    total,
)
from sublens.load_date import LoadDate, within
from sublens.operators.latest import first_per_key

# Fixed values of the service platform.
DONE = 2
EXCLUDED_ACTION = 30
EXCLUDED_EVENT = 109
VAS_TYPES = ["VOIP", "Netflix", "Anghami", "AppleWatch", "Entertainer"]
SERVICE_GROUPS = ["VAS", "Booster", "Roaming"]
HISTORY_SINCE = date(2018, 1, 1)
PAYMENT_DAYS = 120
AMOUNT_DAYS = 30

# Output columns in report order.
EVENT_ACTION_COLUMNS = """
IN_ACCOUNT_NUMBER
BOOSTER_LAST_DATA BOOSTER_LAST_NATL BOOSTER_LAST_INTL
BOOSTER_LAST_DATE_NATL BOOSTER_LAST_DATE_DATA BOOSTER_LAST_DATE_INTL
DAYS_SINCE_LAST_BOOSTER_PURCHASE DAYS_TILL_BOOSTER_EXPIRY DAYS_SINCE_BOOSTER_EXPIRY
DAYS_TILL_DATA_BOOSTER_EXPIRY DAYS_SINCE_DATA_BOOSTER_EXPIRY
DAYS_TILL_NATL_BOOSTER_EXPIRY DAYS_SINCE_NATL_BOOSTER_EXPIRY
DAYS_TILL_INTL_BOOSTER_EXPIRY DAYS_SINCE_INTL_BOOSTER_EXPIRY
VOIP_SERVICE NETFLIX_SERVICE_FLAG VAS_SERVICE_FLAG ANGHAMI_SERVICE_FLAG ENTERTAINER_SERVICE_FLAG
BOTIM_SERVICE_FLAG VOIP_RENEWAL_DATE APPLE_WATCH_SERVICE APPLE_WATCH_RENEWAL_DATE
ANGHAMI_RENEWAL_DATE NETFLIX_RENEWAL_DATE ENTERTAINER_RENEWAL_DATE BOTIM_RENEWAL_DATE
VAS_RENEWAL_DATE VAS_TOTAL_AMOUNT VAS_USAGE_RIGHT_FLAG
LAST_DATA_ROAMING_BUNDLE LAST_DATA_ROAMING_BUNDLE_PURCHASE_DATE
LAST_DATA_ROAMING_PASS LAST_DATA_ROAMING_PASS_PURCHASE_DATE
LAST_VOICE_ROAMING_BUNDLE LAST_VOICE_ROAMING_BUNDLE_PURCHASE_DATE
LAST_VOICE_ROAMING_PASS LAST_VOICE_ROAMING_PASS_PURCHASE_DATE
""".split()


def first_event_rows(tables) -> DataFrame:
    """The first event row per base event; compared through ``dev_eventid_base``."""
    return first_per_key(
        tables["nobill_dim_event"], ["dev_eventid_base"], [F.asc_nulls_last("dev_event_id")]
    )


def service_master(tables) -> DataFrame:
    """Services with their names, counters, event categories and report group; one row per bundled event."""

    def names(table: str, key: str, name: str) -> DataFrame:
        return tables[table].select(F.col("Id").alias(key), F.col("Name").alias(name))

    services = tables["po_po_service"].select(
        F.col("Id").alias("ServiceId"),
        F.col("Name").alias("ServiceName"),
        "ServiceChargingTypeId",
        "ServiceTypeId",
        "ServiceCategoryId",
        "ServiceCost",
        F.col("StatusId").alias("ServiceStatusId"),
        F.col("CreationDate").alias("ServiceCreationDate"),
    )
    events = first_event_rows(tables).select(
        F.col("dev_eventid_base").alias("EventId"),
        "dev_event_desc",
        "dev_category_1",
        "dev_category_2",
        "dev_category_3",
        "dev_category_4",
    )
    categories = names("po_po_servicecategory", "ServiceCategoryId", "ServiceCategoryName")
    types = names("po_po_servicetype", "ServiceTypeId", "ServiceTypeName")
    charging = names("po_po_servicechargingtype", "ServiceChargingTypeId", "ServiceChargingTypeName")
    return (
        services.join(categories, "ServiceCategoryId", "left")
        .join(types, "ServiceTypeId", "left")
        .join(charging, "ServiceChargingTypeId", "left")
        .join(tables["po_po_bundle"], "ServiceId", "left")
        .join(events, "EventId", "left")
        .withColumn(
            "ServiceGroup", decode.service_group(F.col("dev_category_1"), F.col("dev_category_3"))
        )
    )


def action_payments(tables, load_date, days: int = PAYMENT_DAYS) -> DataFrame:
    """What was paid for each action within the last ``days``."""
    day = LoadDate.of(load_date)
    paid = tables["po_sre_paymenthistory"].where(
        F.col("IsSuccess")
        & within(F.to_date("DateTime"), day.back(days), day.day)
        & F.col("ActionHistoryId").isNotNull()
        & (F.col("PaidAmount") > 0)
    )
    return paid.groupBy("ActionHistoryId").agg(F.sum("PaidAmount").alias("PaidAmount"))


def latest_action_per_group(tables, load_date, since: date = HISTORY_SINCE) -> DataFrame:
    """Newest service action per (account, group, category).

    Group and category follow from the first service id and the account from the customer, so the
    long history is first cut to the newest action per (customer, service); only that remainder
    meets the lookups.
    """
    day = LoadDate.of(load_date)
    services = F.col("ServiceIds")
    actions = tables["po_sre_actionhistory"].where(
        within(F.to_date("DateTime"), since, day.day)
        & (F.char_length(services) > 1)
        & (F.col("StatusId") == DONE)
        & ~services.like("%,%,%")
        & (F.col("ActionId") != EXCLUDED_ACTION)
    )
    first_service = F.split_part(services, F.lit(","), F.lit(1)).try_cast("bigint")
    newest = first_per_key(
        actions.select("Id", "ActionId", "DateTime", "CustomerId", "SubscriptionId", first_service.alias("ServiceId")),
        ["CustomerId", "ServiceId"],
        [F.desc("Id")],
    )
    master = service_master(tables).where(F.col("ServiceGroup").isin(SERVICE_GROUPS))
    customers = tables["po_sre_customer"].select(
        F.col("Id").alias("CustomerId"), F.col("NobillAccountNo").alias("IN_ACCOUNT_NUMBER")
    )
    grouped = newest.join(
        master.select("ServiceId", "EventId", "ServiceGroup", "dev_category_3"), "ServiceId"
    ).join(customers, "CustomerId", "left")
    return first_per_key(
        grouped,
        ["IN_ACCOUNT_NUMBER", "ServiceGroup", "dev_category_3"],
        [F.desc("Id"), F.asc_nulls_last("EventId")],
    )


def _account_tests(account: Column) -> Column:
    return (F.length(account) > 1) & ~account.contains("_")


def dated_services(tables, load_date, since: date = HISTORY_SINCE) -> DataFrame:
    """Newest actions with their service type, subscription dates and amount paid."""
    day = LoadDate.of(load_date)
    actions = latest_action_per_group(tables, day, since).where(
        (F.col("EventId") != EXCLUDED_EVENT) & _account_tests(F.col("IN_ACCOUNT_NUMBER"))
    )
    files = tables["po_service_file"].select(
        F.col("EXCEL_SERVICE_EVENT_ID").try_cast("int").alias("EventId"),
        F.col("EXCEL_SERVICE_TYPE").alias("service_type"),
        F.col("EXCEL_SERVICE_CATEGORY").alias("service_category"),
        F.col("EXCEL_SERVICE_DESCRIPTION").alias("description"),
    )
    subscriptions = tables["po_sre_subscription"].select(
        F.col("Id").alias("SubscriptionId"),
        F.to_date("StartDate").alias("start"),
        F.to_date("EndDate").alias("end"),
    )
    payments = action_payments(tables, day).withColumnRenamed("ActionHistoryId", "Id")
    return (
        actions.join(payments, "Id", "left")
        .join(files, "EventId", "left")
        .join(subscriptions, "SubscriptionId", "left")
        .withColumn("recent", F.col("DateTime") >= F.lit(day.back(AMOUNT_DAYS)).cast("timestamp_ntz"))
    )


def event_action_features(day: LoadDate) -> dict[str, Column]:
    """The conditional aggregates, by output column."""
    kind, start, end = F.col("service_type"), F.col("start"), F.col("end")
    vas = kind.isin(VAS_TYPES)
    booster = F.col("service_category") == "Booster"

    def running(test: Column) -> Column:
        return flag(latest(test, end) >= F.lit(day.day))

    active = vas & (end >= F.lit(day.day))
    features = {
        "VAS_SERVICE_FLAG": running(vas),
        "VAS_RENEWAL_DATE": F.coalesce(earliest(active, end), latest(vas, end)),
        "VAS_TOTAL_AMOUNT": as_double(total(vas & F.col("recent"), F.col("PaidAmount"))),
        "VAS_USAGE_RIGHT_FLAG": F.lit(0),
        "VOIP_SERVICE": running(kind == "VOIP"),
        "BOTIM_SERVICE_FLAG": running(kind == "VOIP"),
        "BOTIM_RENEWAL_DATE": latest(kind == "VOIP", end),
        "NETFLIX_SERVICE_FLAG": running(kind == "Netflix"),
        "ANGHAMI_SERVICE_FLAG": running(kind == "Anghami"),
        "APPLE_WATCH_SERVICE": running(kind == "AppleWatch"),
        "ENTERTAINER_SERVICE_FLAG": running(kind == "Entertainer"),
        "DAYS_SINCE_LAST_BOOSTER_PURCHASE": days_since(day.day, latest(booster, start)),
        "DAYS_SINCE_BOOSTER_EXPIRY": days_since(day.day, latest(booster, end)),
        "DAYS_TILL_BOOSTER_EXPIRY": days_until(day.day, latest(booster, end)),
    }
    renewals = {
        "VOIP": "VOIP",
        "NETFLIX": "Netflix",
        "ANGHAMI": "Anghami",
        "APPLE_WATCH": "AppleWatch",
        "ENTERTAINER": "Entertainer",
    }
    for label, name in renewals.items():
        features[f"{label}_RENEWAL_DATE"] = latest(kind == name, end)
    roaming = {
        "DATA_ROAMING_BUNDLE": "DATA_ROM",
        "VOICE_ROAMING_BUNDLE": "VOICE_OUT_ROM",
        "DATA_ROAMING_PASS": "DATA_PASS_ROM",
        "VOICE_ROAMING_PASS": "VOICE_PASS_ROM",
    }
    for label, name in roaming.items():
        features[f"LAST_{label}"] = latest(kind == name, F.col("description"))
        features[f"LAST_{label}_PURCHASE_DATE"] = latest(kind == name, start)
    for label, name in {"DATA": "DATA", "NATL": "VOICE_LCL", "INTL": "VOICE_INT"}.items():
        one_kind = booster & (kind == name)
        features[f"BOOSTER_LAST_{label}"] = latest(one_kind, F.col("description"))
        features[f"BOOSTER_LAST_DATE_{label}"] = latest(one_kind, start)
        features[f"DAYS_SINCE_{label}_BOOSTER_EXPIRY"] = days_since(day.day, latest(one_kind, end))
        features[f"DAYS_TILL_{label}_BOOSTER_EXPIRY"] = days_until(day.day, latest(one_kind, end))
    return features


def event_action_history(
    tables, load_date, since: date = HISTORY_SINCE, blank_placeholders: bool = False
) -> DataFrame:
    """One row per account: last items, renewal dates, days to and from expiry, amounts."""
    day = LoadDate.of(load_date)
    features = event_action_features(day)
    if blank_placeholders:
        features["VAS_USAGE_RIGHT_FLAG"] = F.lit("")
    return dated_services(tables, day, since).groupBy("IN_ACCOUNT_NUMBER").agg(
        *[features[name].alias(name) for name in EVENT_ACTION_COLUMNS[1:]]
    )
