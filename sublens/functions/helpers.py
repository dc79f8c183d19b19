"""Small column helpers shared by the pipelines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(condition: Column, value) -> Column:
    """Sum of ``value`` where the condition holds, 0 elsewhere (never NULL for a non-empty group)."""
    return F.sum(F.when(condition, value).otherwise(0))


def window_total(on: str, window: tuple[date, date], value: str) -> Column:
    """Sum of a column over the rows dated within the half-open window, 0 without any.

    Written as SQL text because reports ask for dozens of these: one call instead of seven each.
    """
    start, end = window
    inside = f"{on} >= date '{start}' and {on} < date '{end}'"
    return F.expr(f"sum(case when {inside} then {value} else 0 end)")


def latest(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def earliest(condition: Column, value: Column) -> Column:
    return F.min(F.when(condition, value))


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def as_double(col: Column) -> Column:
    return col.cast("double")


def days_since(day: date, col: Column) -> Column:
    return F.datediff(F.lit(day), col)


def days_until(day: date, col: Column) -> Column:
    return F.datediff(col, F.lit(day))


def truncate(col: Column, places: int = 0) -> Column:
    """Cut a number to ``places`` decimals towards zero.

    Goes through a decimal, so that 0.29 keeps its 29 hundredths instead of becoming 0.28.
    """
    scaled = (col.cast("decimal(28,10)") * F.lit(10**places)).cast("bigint")
    return scaled if places == 0 else scaled / F.lit(float(10**places))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def number_key(col: Column) -> Column:
    """Key for comparing a numeric account with one held as text; non-numbers match nothing."""
    return col.try_cast("bigint")


def age_in_years(birth: Column, on: date) -> Column:
    """Completed years at ``on``; a 29 February birthday is reached on 1 March of common years."""
    before_birthday = (F.month(birth) > on.month) | (
        (F.month(birth) == on.month) & (F.dayofmonth(birth) > on.day)
    )
    return F.lit(on.year) - F.year(birth) - F.when(before_birthday, 1).otherwise(0)


def birthday_bucket(birth: Column, on: date) -> Column:
    """Place a birthday relative to ``on`` by month and ISO week number.

    A birthday of the next month is found by month number + 1, hence never from December, and
    the coming week only counts inside the same month. A missing date falls through to 'Later'.
    """
    week = on.isocalendar().week
    same_month = F.month(birth) == on.month
    born_week = F.weekofyear(birth)
    return (
        F.when(same_month & (F.dayofmonth(birth) == on.day) & (born_week == week), "Today")
        .when(same_month & (born_week == week), "Current Week")
        .when(same_month & (born_week == week + 1), "Upcoming Week")
        .when(same_month, "Current Month")
        .when(F.month(birth) == on.month + 1, "Next Month")
        .otherwise("Later")
    )


def same_day_of_year(col: Column, on: date) -> Column:
    return flag((F.month(col) == on.month) & (F.dayofmonth(col) == on.day))
