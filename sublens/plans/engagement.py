"""Roaming trips, data sharing and loyalty."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.functions.helpers import as_double, flag
from sublens.load_date import LoadDate, within, within_closed
from sublens.operators.daily_sets import DailySets, distinct_over_dates
from sublens.operators.latest import collapse, first_per_key
from sublens.operators.ordered import previous_in_order
from sublens.operators.rolling import DateList, Span

# Fixed values.
HOME_MCC = 424
HOME_COUNTRY = "Uae"
UNKNOWN_COUNTRY = "Others"
TEST_NETWORKS = ["000", "901"]
SHARE_ACTION = 32
DONE = 2
SHARE_LIMIT_MB = 10240
SHARING_SINCE = date(2022, 1, 1)
LOYALTY_DAYS = 30

# How many consecutive message ids meet in one task when country changes are looked for.
ID_BLOCK = 50_000_000


def _countries(tables) -> DataFrame:
    return collapse(tables["dim_roam_country_operator"], "MCC", country="country")


def network_messages(tables, start: date, end: date) -> DataFrame:
    """Messages of ``[start, end)`` from networks that are no test networks."""
    return tables["roaming_ussd_received_data"].where(
        within(F.to_date("DATETIME"), start, end)
        & F.col("MCC").rlike("[0-9]")
        & ~F.col("MCC").isin(TEST_NETWORKS)
    )


def _country() -> Column:
    """The country of a network that was looked up in ``_countries``."""
    home = F.col("MCC").try_cast("int") == HOME_MCC
    return F.when(home, HOME_COUNTRY).otherwise(F.coalesce("country", F.lit(UNKNOWN_COUNTRY)))


def visited_countries(tables, load_date) -> DataFrame:
    """Network messages of the last six months with the country they came from."""
    day = LoadDate.of(load_date)
    messages = network_messages(tables, day.months_back(6, day.previous), day.day)
    return messages.join(_countries(tables), "MCC", "left").select(
        "ID", "MSISDN", F.to_date("DATETIME").alias("seen_on"), _country().alias("country")
    )


def _moves(tables, load_date, id_block: int) -> DataFrame:
    """Messages sent from another country than the message before, whose country is given as a number.

    The number has a fixed width, so that looking for each bucket's last message stays a hash aggregate.
    """
    stream = previous_in_order(
        visited_countries(tables, load_date).withColumn("country_key", F.xxhash64("country")),
        ["MSISDN"],
        ["ID"],
        F.floor(F.col("ID") / id_block),
        {"previous_key": "country_key"},
    )
    moved = F.col("previous_key").isNull() | (F.col("country_key") != F.col("previous_key"))
    return stream.where(moved).drop("country_key")


def country_changes(tables, load_date, id_block: int = ID_BLOCK) -> DataFrame:
    """Messages sent from another country than the subscriber's message before, home included."""
    fixed = F.array(F.lit(HOME_COUNTRY), F.lit(UNKNOWN_COUNTRY))
    listed = _countries(tables).agg(F.collect_set("country").alias("names"))
    names = listed.select(F.explode(F.array_union("names", fixed)).alias("previous_country"))
    keyed = names.withColumn("previous_key", F.xxhash64("previous_country"))
    return _moves(tables, load_date, id_block).join(keyed, "previous_key", "left").drop("previous_key")


def roaming_trips(tables, load_date, id_block: int = ID_BLOCK) -> DataFrame:
    """Trips abroad within 1, 3 and 6 months and the number of countries visited."""
    day = LoadDate.of(load_date)
    trips = _moves(tables, day, id_block).where(F.col("country") != HOME_COUNTRY)

    def since(months: int):
        recent = F.col("seen_on") >= F.lit(day.months_back(months, day.previous))
        return F.sum(flag(recent))

    # One row per subscriber and country first, so that counting countries needs no distinct.
    per_country = trips.groupBy("MSISDN", "country").agg(
        since(1).alias("m1"), since(3).alias("m3"), F.count(F.lit(1)).alias("m6")
    )
    per_number = per_country.groupBy("MSISDN").agg(
        F.sum("m1").alias("RLH_1M"),
        F.sum("m3").alias("RLH_3M"),
        F.sum("m6").alias("RLH_6M"),
        F.count("country").alias("RLH_UNIQUE_COUNTRY_6M"),
    )
    accounts = collapse(tables["customer_master"], "MSISDN", IN_ACCOUNT_NUMBER="IN_ACCOUNT_NUMBER")
    return per_number.join(accounts, "MSISDN", "left").select(
        "IN_ACCOUNT_NUMBER",
        "MSISDN",
        F.lit("").alias("ROAMING_BL"),
        "RLH_1M",
        "RLH_3M",
        "RLH_6M",
        "RLH_UNIQUE_COUNTRY_6M",
    )


def roaming_windows(load_date) -> dict[str, Span]:
    """Half-open windows of 1, 3 and 6 months up to L - 1."""
    day = LoadDate.of(load_date)
    return {f"{months}M": (day.months_back(months, day.previous), day.day) for months in (1, 3, 6)}


def _abroad(messages: DataFrame, tables) -> DataFrame:
    """Rows with a network, and its country, that were not sent from home."""
    known = messages.join(_countries(tables), "MCC", "left").withColumn("country", _country())
    return known.where(F.col("country") != HOME_COUNTRY)


def _country_counts(counts: DataFrame, *columns: str) -> DataFrame:
    named = [F.col(f"n_{w}").cast("long").alias(f"RLH_UNIQUE_COUNTRY_{w}") for w in ("1M", "3M", "6M")]
    return counts.select(*columns, "MSISDN", *named)


def countries_over_dates(tables, load_dates: Sequence) -> DataFrame:
    """Countries abroad a subscriber was seen in within 1, 3 and 6 months, for several load dates from one scan.

    Every stay abroad begins with a trip, so those of 6 months are the countries that ``roaming_trips`` counts.
    """
    dates = DateList([LoadDate.of(d).day for d in load_dates], roaming_windows)
    # One row per subscriber, network and day before the names are looked up.
    messages = network_messages(tables, *dates.scan)
    days = messages.select("MSISDN", "MCC", F.to_date("DATETIME").alias("seen_on")).distinct()
    return _country_counts(
        distinct_over_dates(_abroad(days, tables), ["MSISDN"], "country", "seen_on", dates), "load_date"
    )


def network_state(spark: SparkSession, folder: str) -> DailySets:
    """The networks a subscriber was seen in, per day.

    Networks and not countries are kept: a run of a load date names all its networks by the list of that day.
    """
    return DailySets(spark, folder, ["MSISDN"], "MCC", roaming_windows)


def store_networks(tables, state: DailySets, start: date, end: date) -> None:
    """Take in the days ``[start, end)`` of the messages, or take them in anew after late rows."""
    seen = network_messages(tables, start, end).select("MSISDN", "MCC", F.to_date("DATETIME").alias("seen_on"))
    state.store_days(seen, "seen_on", [start + timedelta(days=n) for n in range((end - start).days)])


def countries_from(tables, state: DailySets, load_date) -> DataFrame:
    """``countries_over_dates`` of one load date from the stored days, without the messages."""
    abroad = _abroad(state.members(LoadDate.of(load_date).day).withColumnRenamed("value", "MCC"), tables)
    windows = list(roaming_windows(load_date))
    # A country may have several networks.
    per_country = abroad.groupBy("MSISDN", "country").agg(*[F.max(f"in_{w}").alias(f"in_{w}") for w in windows])
    counts = per_country.groupBy("MSISDN").agg(*[F.sum(flag(F.col(f"in_{w}"))).alias(f"n_{w}") for w in windows])
    return _country_counts(counts)


def data_sharing(tables, load_date, since: date = SHARING_SINCE) -> DataFrame:
    """The donation on the longest-running plan of an account and what may still be shared of it."""
    donations = tables.history("po_sre_actionhistory", load_date).where(
        (F.col("ActionId") == SHARE_ACTION)
        & (F.to_date("DateTime") >= F.lit(since))
        & (F.col("StatusId") == DONE)
    )
    shares = tables["po_sre_shareplanhistory"].where(F.col("IsSuccess") == 1)
    customers = tables["po_sre_customer"].select(
        F.col("Id").alias("CustomerId"), F.col("NobillAccountNo").alias("IN_ACCOUNT_NUMBER")
    )
    subscriptions = tables["po_sre_subscription"].select(
        F.col("Id").alias("SubscriptionId"), "StartDate", "EndDate"
    )
    donated = (
        donations.select(F.col("Id").alias("ActionHistoryId"), "CustomerId", F.to_date("DateTime").alias("given_on"))
        .join(
            shares.select(F.col("Id").alias("share_id"), "ActionHistoryId", "SubscriptionId", "CounterValue"),
            "ActionHistoryId",
        )
        .join(subscriptions, "SubscriptionId", "left")
        .join(customers, "CustomerId", "left")
    )
    newest = first_per_key(
        donated,
        ["IN_ACCOUNT_NUMBER"],
        [F.desc_nulls_last(c) for c in ("EndDate", "ActionHistoryId", "share_id", "CounterValue")],
    )
    megabytes = F.col("CounterValue") / 1024 / 1024
    on_current_plan = F.col("given_on") >= F.to_date("StartDate")
    return newest.select(
        "IN_ACCOUNT_NUMBER",
        F.col("given_on").alias("DATA_SHARING_DONATION_DATE"),
        megabytes.alias("DS_SENDER_SEND_VALUE"),
        "StartDate",
        "EndDate",
        F.when(on_current_plan, SHARE_LIMIT_MB - megabytes).otherwise(0.0).alias("DATA_AVAILABLE_TO_SHARE"),
    )


def loyalty_accounts(tables) -> DataFrame:
    """Loyalty customer to account; a customer unknown to the master has no account."""
    customers = tables["loy_dim_customer"].select(
        F.col("ID").alias("customer_id"), F.col("identifier_value").alias("CRM_UID")
    )
    master = tables["customer_master"].select("CRM_UID", "IN_ACCOUNT_NUMBER")
    return customers.join(master, "CRM_UID", "left").select("customer_id", "IN_ACCOUNT_NUMBER")


def loyalty_points(tables, load_date) -> DataFrame:
    """Points of ``[L-30, L]`` per account, those of unknown customers on one row without account."""
    day = LoadDate.of(load_date)
    log = tables["loy_customer_trx_log"].where(
        within_closed(F.to_date("CREATE_DATE"), day.back(LOYALTY_DAYS), day.day)
    )
    per_customer = log.groupBy("customer_id").agg(F.sum("points").alias("points"))
    return (
        per_customer.join(loyalty_accounts(tables), "customer_id", "left")
        .groupBy("IN_ACCOUNT_NUMBER")
        .agg(as_double(F.sum("points")).alias("points"))
        .orderBy("IN_ACCOUNT_NUMBER")
    )


def loyalty_tier(tables, load_date) -> DataFrame:
    """Tier of the newest cashback row that has one, per loyalty customer."""
    tiered = tables.history("loy_customer_cashback", load_date).where(F.col("tier_id").isNotNull())
    newest = first_per_key(
        tiered, ["customer_id"], [F.desc_nulls_last("CREATE_DATE"), F.desc_nulls_last("id")]
    )
    tiers = tables["loy_tier"].select(F.col("ID").alias("tier_id"), "name_en")
    return (
        newest.join(tiers, "tier_id", "left")
        .join(loyalty_accounts(tables), "customer_id", "left")
        .select("IN_ACCOUNT_NUMBER", "name_en")
    )
