from datetime import date

import pytest

from sublens.load_date import LoadDate, add_months
from sublens.plans.booster import purchase_windows
from sublens.plans.payments import payment_windows
from sublens.plans.usage import usage_windows_of


@pytest.mark.parametrize(
    "day, months, expected",
    [
        (date(2023, 3, 31), -1, date(2023, 2, 28)),
        (date(2024, 3, 31), -1, date(2024, 2, 29)),
        (date(2023, 1, 15), -13, date(2021, 12, 15)),
        (date(2023, 12, 31), 2, date(2024, 2, 29)),
    ],
)
def test_add_months_clamps_to_month_end(day, months, expected):
    assert add_months(day, months) == expected


def test_accepts_text_date_and_itself():
    day = LoadDate.of("2023-03-01")
    assert day.day == date(2023, 3, 1)
    assert LoadDate.of(day) is day
    assert LoadDate.of(date(2023, 3, 1)) == day


def test_month_of_the_previous_day_on_the_first():
    day = LoadDate.of("2023-03-01")
    assert day.month_start() == date(2023, 2, 1)
    assert day.month_start(2) == date(2022, 12, 1)
    assert day.load_month() == (date(2023, 3, 1), date(2023, 4, 1))


def test_booster_windows_are_disjoint_and_half_open():
    windows = purchase_windows("2023-06-15")
    assert windows["LAST_30DAYS"] == (date(2023, 5, 16), date(2023, 6, 15))
    assert windows["LAST_31_60DAYS"][1] == windows["LAST_30DAYS"][0]
    assert windows["M1"] == (date(2023, 5, 1), date(2023, 6, 1))


def test_first_payment_window_has_31_days():
    start, end = payment_windows("2023-06-15")["last_30_days"]
    assert (end - start).days == 31


def test_usage_windows_share_their_edges_and_count_months_from_the_load_date():
    windows = usage_windows_of("2023-06-01")
    assert windows["30_days"][0] == windows["30_60_days"][1]
    assert windows["30_60_days"][0] == windows["60_90_days"][1]
    assert windows["M_0"] == (date(2023, 6, 1), date(2023, 6, 1))
