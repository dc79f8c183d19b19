from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import (
    age_in_years,
    birthday_bucket,
    digits,
    flag,
    number_key,
    ratio,
    truncate,
)


def apply(spark, column, values, type_):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "birth, on, years",
    [
        (date(2000, 2, 29), date(2023, 2, 28), 22),
        (date(2000, 2, 29), date(2023, 3, 1), 23),
        (date(2000, 6, 15), date(2024, 6, 14), 23),
        (date(2000, 6, 15), date(2024, 6, 15), 24),
        (None, date(2024, 6, 15), None),
    ],
)
def test_age_in_whole_years(spark, birth, on, years):
    assert apply(spark, lambda c: age_in_years(c, on), [birth], "date") == [years]


def test_missing_birth_date_is_not_young(spark):
    assert apply(spark, lambda c: flag(age_in_years(c, date(2024, 1, 1)) <= 24), [None], "date") == [0]


@pytest.mark.parametrize(
    "birth, on, bucket",
    [
        (date(2001, 1, 24), date(2024, 1, 24), "Today"),
        (date(1990, 1, 23), date(2024, 1, 24), "Current Week"),
        (date(1990, 1, 30), date(2024, 1, 24), "Upcoming Week"),
        (date(1990, 1, 3), date(2024, 1, 24), "Current Month"),
        (date(1990, 2, 3), date(2024, 1, 24), "Next Month"),
        (date(1990, 1, 3), date(2023, 12, 24), "Later"),
        (None, date(2024, 1, 24), "Later"),
    ],
)
def test_birthday_bucket(spark, birth, on, bucket):
    assert apply(spark, lambda c: birthday_bucket(c, on), [birth], "date") == [bucket]


def test_truncate_towards_zero(spark):
    values = [0.29, -0.299, 12.999, None]
    assert apply(spark, lambda c: truncate(c, 2), values, "double") == [0.29, -0.29, 12.99, None]
    assert apply(spark, truncate, values, "double") == [0, 0, 12, None]


def test_ratio_of_zero_is_missing(spark):
    assert apply(spark, lambda c: ratio(F.lit(1), c), [0.0, 4.0, None], "double") == [None, 0.25, None]


def test_text_keys(spark):
    assert apply(spark, digits, ["a1b2", "", None], "string") == ["12", "", None]
    assert apply(spark, number_key, ["0012", "x", "", "9" * 30], "string") == [12, None, None, None]


def test_usage_tier_edges(spark):
    values = [0.0, 5.0, 5.1, 10.0, 15.0, 25.0, 50.0, 50.1, None]
    tiers = ["5", "5", "10", "10", "15", "25", "50", ">50", ">50"]
    assert apply(spark, decode.usage_tier, values, "double") == tiers


@pytest.mark.parametrize(
    "in_life, last_30, days_31_60, before_30, profile",
    [
        (0, None, None, 0, "Never"),
        (5, 1, 1, 4, "Frequent"),
        (1, 1, 0, 0, "1st Time"),
        (1, 0, 0, 1, "One Time"),
        (1, None, None, 1, "One Time"),
        (4, 1, 0, 3, "Occasional"),
        (4, None, None, 4, "Occasional"),
    ],
)
def test_purchase_profile(spark, in_life, last_30, days_31_60, before_30, profile):
    df = spark.createDataFrame([(in_life, last_30, days_31_60, before_30)], "a int, b int, c int, d int")
    assert df.select(decode.purchase_profile(*map(F.col, "abcd"))).first()[0] == profile


@pytest.mark.parametrize(
    "status, blocked, service, expected",
    [
        (3, 0, None, "ACTIVE"),
        (3, 0, "CS.TRA_Blocking", "DEACTIVE"),
        (3, 0, "CS.ID_Expiry_1W_Blocking", "SUSPENDED"),
        (3, 2, None, "SUSPENDED"),
        (3, 1, None, "DEACTIVE"),
        (6, 0, "CS.ID_Expiry_1W_Blocking", "DEACTIVE"),
        (4, 0, None, "DEACTIVE"),
        (3, None, None, "DEACTIVE"),
        (None, 0, None, "DEACTIVE"),
    ],
)
def test_line_status(spark, status, blocked, service, expected):
    df = spark.createDataFrame([(status, blocked, service)], "s int, b int, v string")
    label = decode.blocked_label(F.col("b"))
    number = decode.number_status(F.col("s"), label)
    assert df.select(decode.line_status(F.col("s"), label, number, F.col("v"))).first()[0] == expected
    daily = decode.snapshot_line_status(F.col("s"), F.col("b"), F.col("v"))
    assert df.select(daily).first()[0] == expected


def test_payment_channel_names(spark):
    values = ["Spotii", "POS", "BankX", None]
    assert apply(spark, decode.payment_channel, values, "string") == ["SPOTII", "POS", "BankX", None]
    folded = apply(spark, decode.payment_channel_fold, ["POS", "Kiosk", None], "string")
    assert folded == ["POS", "Others", None]


def test_product_ladder_is_ordered(spark):
    names = ["Product Broadband", "Product Broadband - 12Months", "Plan_6Months", "x24Month", "Product-Staff", "Gold"]
    groups = ["MBB", "MBB-12 Months", "6 Months", "12 Months", "Monthly", "Gold"]
    assert apply(spark, decode.product_group, names, "string") == groups
    categories = ["Monthly", "Annual", "Monthly", "Monthly", "Monthly", "Monthly"]
    assert apply(spark, decode.product_category, names, "string") == categories


def test_spend_flag(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(decode.spend_flag(F.col("a"), F.col("b"))).collect()] == [1, 0, 2, 2]


def test_money_keeps_cents(spark):
    assert apply(spark, lambda c: c.cast("decimal(18,2)"), [0.1], "double") == [Decimal("0.10")]
