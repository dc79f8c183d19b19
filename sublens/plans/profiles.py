"""Acquisition, demographics and status: the customer base joined to what is known of the customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import (
    age_in_years,
    birthday_bucket,
    days_since,
    digits,
    flag,
    number_key,
    same_day_of_year,
)
from sublens.load_date import LoadDate
from sublens.operators.joins import repeat_rows, with_existence
from sublens.operators.latest import duplicated_keys, first_per_key
from sublens.plans.customer_base import customer_base, last_port_out, ported_in

ACCOUNT_LIMIT = 5
YOUTH_AGE = 24


def registered_customers(tables) -> DataFrame:
    """Master rows with a registration id; an empty or missing id drops the row."""
    master = tables["customer_master"].where(F.col("REGISTRATION_ID") != "")
    return master.withColumn("account", number_key(F.col("IN_ACCOUNT_NUMBER"))).drop("IN_ACCOUNT_NUMBER")


def known_customers(tables, load_date, base: DataFrame | None = None) -> DataFrame:
    """The customer base with the master columns of each account.

    A job that runs several profiles writes the customer base once and passes it in as ``base``.
    """
    if base is None:
        # Cut off by a shuffle: else one task holds the sorts of the base and those of all later joins by account
        # at once. By account alone it would be left out, since the base comes out of joins by account.
        base = customer_base(tables, load_date).repartition("IN_ACCOUNT_NUMBER", "STATUS")
    customers = registered_customers(tables)
    return base.join(customers, base["IN_ACCOUNT_NUMBER"] == customers["account"], "left").drop("account")


def account_limit_flags(tables, limit: int = ACCOUNT_LIMIT) -> DataFrame:
    """Per identity document: 1 when at least ``limit`` active accounts share it."""
    active = tables["customer_master"].where(F.col("LATEST_LINE_STATUS") == "ACTIVE")
    return active.groupBy("CUST_LATEST_ID_NUMBER").agg(
        flag(F.count(F.lit(1)) >= limit).alias("MAX_ACCOUNTS_LIMIT_FLAG")
    )


def survey_answers(tables, load_date) -> DataFrame:
    """Survey answers whose free text holds an account number of at least two digits."""
    answers = tables.history("usabilla_data", load_date).withColumn("UID", digits(F.col("extra_info")))
    return answers.where(F.length("UID") > 1)


def survey_rows(tables, load_date) -> DataFrame:
    """Every answer, once per matching campaign row."""
    campaigns = tables["usabilla_campaigns"]
    return survey_answers(tables, load_date).join(campaigns, "campaign_id", "left").select("score", "UID")


def survey_latest(tables, load_date) -> DataFrame:
    """The newest answer per UID. The campaign join could only repeat rows, so it is left out."""
    answers = survey_answers(tables, load_date).withColumn("answered_at", F.col("_date").try_cast("timestamp_ntz"))
    newest = first_per_key(
        answers, ["UID"], [F.desc_nulls_last("answered_at"), F.desc_nulls_last("score")]
    )
    return newest.select("score", "UID")


def survey_counts(tables, load_date, by: Sequence[str] = ()) -> DataFrame:
    """How many answer rows each account has, in all or for each value of ``by``: a pipeline repeats its rows by it."""
    per_campaign = tables["usabilla_campaigns"].groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("campaign_rows")
    )
    answers = (
        survey_answers(tables, load_date).groupBy("UID", "campaign_id", *by).agg(F.count(F.lit(1)).alias("answers"))
    )
    rows = answers.join(per_campaign, "campaign_id", "left").withColumn(
        "answer_rows", F.col("answers") * F.coalesce("campaign_rows", F.lit(1))
    )
    return (
        rows.groupBy(number_key(F.col("UID")).alias("IN_ACCOUNT_NUMBER"), *by)
        .agg(F.sum("answer_rows").alias("answer_rows"))
    )


def with_survey_fan_out(df: DataFrame, tables, load_date) -> DataFrame:
    """One row per survey answer, without carrying the answers through the join."""
    counted = df.join(survey_counts(tables, load_date), "IN_ACCOUNT_NUMBER", "left")
    return repeat_rows(counted, "answer_rows", by=["IN_ACCOUNT_NUMBER"])


def acquisition(tables, load_date, base: DataFrame | None = None) -> DataFrame:
    day = LoadDate.of(load_date)
    registrations = tables.history("vmwsc_registration", day).select(
        F.col("ID").alias("REGISTRATION_ID"), "IsEmailVerified"
    )
    port_ins = ported_in(tables, day).withColumnRenamed("accountnum", "IN_ACCOUNT_NUMBER")
    customers = known_customers(tables, day, base)
    typed = with_existence(
        customers, port_ins, "IN_ACCOUNT_NUMBER", "ACTIVATION_TYPE", "MNP", "Standard"
    )
    # copies of an account come last, so that no later join has to shuffle them by one key
    complete = with_survey_fan_out(typed.join(registrations, "REGISTRATION_ID", "left"), tables, day)
    return complete.select(
        "IN_ACCOUNT_NUMBER",
        decode.payment_channel_fold(F.col("FLAG_POD_POS_COD")).alias("ACTIVATION_PAYMENT_CHANNEL"),
        F.col("CUST_REGISTRATION_CHANNEL").alias("EMAIL_REGISTRATION_CHANNEL"),
        "ACTIVATION_TYPE",
        decode.resident_class(F.col("CUST_LATEST_ID_TYPE")).alias("ACTIVATION_ID_TYPE"),
        F.to_date("FULL_ACTIVATION_DATE").alias("ACTIVATION_DATE"),
        F.col("SALES_CHANNEL").alias("ACTIVATION_CHANNEL"),
        days_since(day.previous, F.to_date("CUST_REGISTRATION_DATE")).alias("EMAIL_REGISTRATION_DATE"),
        F.lit(None).cast("date").alias("FUNNEL_EVENT_DATE"),
        flag(F.col("IsEmailVerified")).alias("EMAIL_VERIFIED_FLAG"),
        F.lit(None).cast("string").alias("FUNNEL_LAST_STEP"),
        F.lit(None).cast("string").alias("FUNNEL_EVENT_NAME"),
    )


def demographics(tables, load_date, base: DataFrame | None = None) -> DataFrame:
    day = LoadDate.of(load_date)
    customers = with_survey_fan_out(known_customers(tables, day, base), tables, day)
    birth = F.col("CUST_DOB")
    return customers.select(
        "IN_ACCOUNT_NUMBER",
        F.col("CRM_UID").alias("CUSTOMER_ID"),
        "REGISTRATION_ID",
        "EMAIL",
        "MSISDN",
        F.col("CUST_NATIONALITY_NAME").alias("NATIONALITY"),
        F.concat("CUST_FIRST_NAME", F.lit(" "), "CUST_LAST_NAME").alias("CUSTOMER_NAME"),
        flag(age_in_years(birth, day.previous) <= YOUTH_AGE).alias("YOUTH_FLAG"),
        birthday_bucket(birth, day.previous).alias("CUSTOMER_DOB"),
        F.col("CUST_LAST_PRODUCT_NAME").alias("USER_TYPE"),
        same_day_of_year(birth, day.previous).alias("NETWORK_ANNIVERSARY_DAY"),
        days_since(day.previous, F.to_date("FULL_ACTIVATION_DATE")).alias("DAYS_SINCE_REGISTRATION"),
    )


def port_out_days(tables, load_date) -> DataFrame:
    day = LoadDate.of(load_date)
    return last_port_out(tables, day).select(
        F.col("accountnum").alias("IN_ACCOUNT_NUMBER"),
        days_since(day.day, F.col("port_out_at")).alias("DAYS_SINCE_PORTOUT"),
    )


def status(
    tables, load_date, newest_answer_only: bool = True, base: DataFrame | None = None
) -> DataFrame:
    """Status, activity and mood per account.

    With ``newest_answer_only=False`` an account appears once per survey answer, which is what the
    duplicate audit is there to find.
    """
    day = LoadDate.of(load_date)
    complete = (
        known_customers(tables, day, base)
        .join(port_out_days(tables, day), "IN_ACCOUNT_NUMBER", "left")
        .join(account_limit_flags(tables), "CUST_LATEST_ID_NUMBER", "left")
    )
    if newest_answer_only:
        scores = survey_latest(tables, day).select(number_key(F.col("UID")).alias("IN_ACCOUNT_NUMBER"), "score")
    else:
        # An account's answers come as one row for each score; copies are made last, of the few columns shown.
        scores = survey_counts(tables, day, by=["score"])
    scored = complete.join(scores, "IN_ACCOUNT_NUMBER", "left")
    shown = scored.select(
        "IN_ACCOUNT_NUMBER",
        F.col("STATUS").alias("CUSTOMER_STATUS"),
        F.col("CUST_DAYS_SINCE_LAST_ACTIVITY").alias("LAST_ACTIVITY_DATE"),
        flag(F.col("DAYS_SINCE_PORTOUT").isNotNull()).alias("FLAG_PORT_OUT"),
        "MAX_ACCOUNTS_LIMIT_FLAG",
        F.col("score").alias("CUSTOMER_SENTIMENT_SCORE"),
        F.col("score").alias("CUSTOMER_MOOD_SCORE_CSAT"),
        *([] if newest_answer_only else ["answer_rows"]),
    )
    if newest_answer_only:
        return shown
    return repeat_rows(shown, "answer_rows", by=["IN_ACCOUNT_NUMBER", "CUSTOMER_SENTIMENT_SCORE"])


def duplicate_audit(tables, load_date, newest_answer_only: bool = False) -> DataFrame:
    """Accounts that the status pipeline returns more than once, with their number of rows.

    For the variant with all answers the rows are counted from the answers per account, without
    producing them.
    """
    if newest_answer_only:
        return duplicated_keys(status(tables, load_date), "IN_ACCOUNT_NUMBER")
    accounts = known_customers(tables, load_date)
    weighted = accounts.join(survey_counts(tables, load_date), "IN_ACCOUNT_NUMBER", "left")
    rows = F.sum(F.coalesce("answer_rows", F.lit(1)))
    return weighted.groupBy("IN_ACCOUNT_NUMBER").agg(rows.alias("ROW_COUNT")).where(F.col("ROW_COUNT") > 1)


def registered_not_activated(tables, start, end) -> DataFrame:
    """Verified registrations in ``[start, end)`` whose CRM account was never activated, newest first."""
    registered = tables["vmwsc_registration"].where(
        F.col("IsEmailVerified")
        & (F.col("DateTime") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("DateTime") < F.lit(end).cast("timestamp_ntz"))
    )
    activated = tables["cas_tx_activations"].select("CRMAccountNo")
    return (
        registered.select(
            F.col("Email").alias("REG_EMAIL"),
            "DateTime",
            "CustomerID",
            F.col("AccountNumber").alias("CRMAccountNo"),
            F.col("IsEmailVerified").alias("EMAIL_VERIFIED_FLAG"),
            F.col("ChannelID").alias("EMAIL_REGISTRATION_CHANNEL"),
        )
        .join(activated, "CRMAccountNo", "left_anti")
        .select(
            "REG_EMAIL",
            "DateTime",
            "CustomerID",
            "CRMAccountNo",
            "EMAIL_VERIFIED_FLAG",
            "EMAIL_REGISTRATION_CHANNEL",
        )
        .orderBy(F.desc_nulls_last("DateTime"))
    )


def newest_tags(tables, load_date, tag: int = 3) -> DataFrame:
    """The newest history row of the tag per number; rows of unknown users share the missing number."""
    tagged = tables.history("ne_scusertaghistory", load_date).where(F.col("TagID") == tag)
    numbers = tables["ne_scuserschannelspermission"].select(F.col("ID").alias("SCUserPerID"), "MSISDN")
    return first_per_key(
        tagged.join(numbers, "SCUserPerID", "left"),
        ["MSISDN"],
        [F.desc_nulls_last("DateTime"), F.desc_nulls_last("ID")],
    )


def tag_cohort(tables, load_date, tag: int = 3) -> DataFrame:
    """Accounts whose number carries the tag."""
    tagged = newest_tags(tables, load_date, tag).select("MSISDN")
    return tables["customer_master"].join(tagged, "MSISDN").select("IN_ACCOUNT_NUMBER")
