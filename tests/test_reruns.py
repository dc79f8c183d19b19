"""Reports of many load dates at once, and carried from day to day, against separate runs."""

import random
from datetime import date, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from checks.binding import ORDERS_L, orders_tables, usage_tables
from checks.reruns import LOAD_DATES
from fixtures import HandMade
from sublens.operators.daily_state import DailyState
from sublens.operators.rolling import DateList, following, totals_over_dates
from sublens.plans import booster, payments, usage
from tests.test_plans import plan_of

SF_DIR = "/root/testdata/sf0.001"
DAY0 = date(2024, 3, 1)


def plus(n: int) -> date:
    return DAY0 + timedelta(days=n)


def windows_of(day: date):
    month = day.replace(day=1)
    return {
        "all": (None, day),
        "week": (day - timedelta(days=7), day),
        "month": (month, day + timedelta(days=1)),
        "old": (day - timedelta(days=20), day - timedelta(days=10)),
    }


def test_totals_of_irregular_dates_equal_summing_each(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), plus(rng.randrange(-60, 60)), rng.randrange(-5, 9)) for _ in range(600)]
    rows += [("late", plus(38), 1), ("early", plus(-500), 7)]
    asked = [plus(n) for n in (35, 0, 1, 2, 9, 31, 30, 2)]
    dates = DateList(asked, windows_of)
    days = spark.createDataFrame(rows, "k string, on date, n int").withColumn("n", F.col("n").cast("decimal(20,2)"))
    found = totals_over_dates(days, ["k"], "on", {w: ["n"] for w in windows_of(DAY0)}, dates, present="all")
    got = {(r["k"], r["load_date"]): tuple(int(r[f"n_{w}"]) for w in windows_of(DAY0)) for r in found.collect()}
    want = {}
    for day in asked:
        for k in {r[0] for r in rows if r[1] < day}:
            want[k, day] = tuple(
                sum(n for key, on, n in rows if key == k and (start is None or on >= start) and on < end)
                for start, end in windows_of(day).values()
            )
    assert got == want


def test_rows_count_from_the_date_they_are_known_at_and_the_newest_is_named(spark):
    rows = [("a", plus(0), plus(3), 1, 7, 100), ("a", plus(2), plus(2), 2, 9, 102), ("a", plus(1), plus(8), 4, 8, 101)]
    days = spark.createDataFrame(rows, "k string, on date, since date, n int, code int, at int")
    dates = DateList([plus(n) for n in range(1, 12)], lambda d: {"week": (d - timedelta(days=7), d)})
    found = totals_over_dates(
        days, ["k"], "on", {"week": ["n"]}, dates, present="week", newest=("code", "at"), known="since"
    )
    got = {(r["load_date"] - DAY0).days: (r["n_week"], r["code"]) for r in found.collect()}
    # the row of day 1 is first known at day 9, when the week has left it behind
    assert got == {3: (2, 9), 4: (3, 9), 5: (3, 9), 6: (3, 9), 7: (3, 9), 8: (2, 9), 9: (2, 9)}


def test_windows_that_go_back_are_refused():
    with pytest.raises(ValueError):
        DateList([plus(0), plus(1)], lambda d: {"w": (plus(5) - (d - DAY0), plus(9))})
    with pytest.raises(ValueError):
        DateList([], windows_of)


def test_following_mark_lies_behind_the_day(spark):
    points = spark.createDataFrame([("a", plus(n)) for n in (0, 1, 4, 9)] + [("b", plus(0))], "k string, on date")
    marks = spark.createDataFrame([("a", plus(n)) for n in (1, 2, 9)] + [("c", plus(3))], "k string, seen date")
    got = {(r["k"], r["on"]): r["seen"] for r in following(points, marks, ["k"], "on", "seen").collect()}
    assert got == {
        ("a", plus(0)): plus(1), ("a", plus(1)): plus(2), ("a", plus(4)): plus(9), ("a", plus(9)): None, ("b", plus(0)): None,
    }


SOME_DATES = [LOAD_DATES[n] for n in (0, 1, 13, 14, 15, 29)]


@pytest.mark.parametrize(
    "tables_of, many, single, named",
    [
        (orders_tables, payments.payments_over_dates, payments.payments, True),
        (orders_tables, payments.wallet_recharges_over_dates, payments.wallet_recharges, False),
        (usage_tables, usage.usage_over_dates, usage.usage_all_windows, False),
        (orders_tables, booster.booster_purchases_over_dates, booster.booster_purchases, False),
    ],
)
def test_one_scan_equals_separate_runs(spark, tables_of, many, single, named):
    tables = tables_of(spark, SF_DIR)
    report = many(tables, SOME_DATES)
    runs = []
    for day in SOME_DATES:
        run = single(tables, day)
        runs.append(run if named else run.withColumn("load_date", F.lit(day)))
    every = reduce(lambda a, b: a.unionByName(b), runs).select(report.columns)
    assert sorted(map(str, report.collect())) == sorted(map(str, every.collect())) != []


@pytest.mark.parametrize(
    "tables_of, many, single",
    [
        (orders_tables, payments.wallet_recharges_over_dates, payments.wallet_recharges),
        (usage_tables, usage.usage_over_dates, usage.usage_all_windows),
        (orders_tables, booster.booster_purchases_over_dates, booster.booster_purchases),
    ],
)
def test_thirty_dates_scan_as_often_as_one(spark, tables_of, many, single):
    tables = tables_of(spark, SF_DIR)
    thirty, one = plan_of(many(tables, LOAD_DATES)), plan_of(single(tables, ORDERS_L))
    assert thirty.count("FileScan") == one.count("FileScan")
    assert "SortAggregate" not in thirty


@pytest.mark.parametrize(
    "tables_of, many",
    [
        (orders_tables, payments.wallet_recharges_over_dates),
        (usage_tables, usage.usage_over_dates),
        (orders_tables, booster.booster_purchases_over_dates),
    ],
)
def test_wide_sums_are_dealt_over_all_tasks_and_not_shuffled(spark, tables_of, many):
    report = many(tables_of(spark, SF_DIR), LOAD_DATES)
    # one shuffle by account in front of the sums; its few bytes here would else be merged into one task
    assert report.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = [line for line in plan_of(report).splitlines() if "Exchange" in line and "__at" in line]
    assert wide == []


def test_days_that_no_window_tells_apart_are_one_row(spark):
    dates = DateList([plus(0), plus(3)], lambda d: {"life": (None, d), "week": (d - timedelta(days=7), d)})
    days = spark.createDataFrame([(plus(n),) for n in (-900, -8, -7, -1, 2, 3, 50)] + [(None,)], "on date")
    place = [f(w, F.col(on)) for on in ("on", "day") for w in ("life", "week") for f in (dates.enters, dates.leaves)]
    found = days.withColumn("day", dates.clamped(F.col("on"))).select("on", "day", F.array(*place).alias("p")).collect()
    assert all(r["p"][:4] == r["p"][4:] for r in found)
    assert {r["on"]: r["day"] for r in found} == {
        plus(-900): plus(-8), plus(-8): plus(-8), plus(-7): plus(-7), plus(-1): plus(-1), plus(2): plus(2),
        plus(3): plus(3), plus(50): plus(3), None: plus(-8),
    }
    tables = HandMade(
        spark,
        event_in_booster=[
            {"EVENT_IN_ACCOUNT_NUMBER": "1", "EVENT_IN_DATE": on, "EVENT_IN_EVENT_ID": "7", "EVENT_IN_EVENT_GROUP": "Booster",
             "EVENT_IN_SERVICE_TYPE": "DATA", "EVENT_IN_TOTAL_QUANTITY": 1}
            for on in [plus(-n) for n in range(1, 400)]
        ],
        po_service_file=[{"EXCEL_SERVICE_EVENT_ID": "7", "EXCEL_SERVICE_TYPE": "DATA"}],
    )
    asked = [plus(-20), plus(0)]
    moving = DateList(asked, booster._dated_windows)
    assert booster.booster_events(tables, asked[-1], moving).count() < 130
    many = booster.booster_purchases_over_dates(tables, asked)
    for day in asked:
        one = booster.booster_purchases(tables, day)
        assert many.where(F.col("load_date") == F.lit(day)).select(one.columns).collect() == one.collect() != []


def test_carried_usage_equals_full_runs_over_a_month_change(spark, tmp_path):
    tables = usage_tables(spark, SF_DIR)
    state = usage.usage_state(spark, str(tmp_path / "state"))
    day = date(1998, 6, 28)

    def same(report, day):
        full = usage.usage_all_windows(tables, day).select(report.columns)
        assert sorted(map(str, report.collect())) == sorted(map(str, full.collect())) != []

    same(usage.start_usage(tables, state, day), day)
    for step in (1, 1, 1, 1, 6):
        following_day = day + timedelta(days=step)
        same(usage.advance_usage(tables, state, day, following_day), following_day)
        day = following_day
    # a step that is repeated gives the same
    same(usage.advance_usage(tables, state, date(1998, 7, 2), day), day)


def small_state(spark, folder) -> DailyState:
    def spans(day):
        return {"scan": (day - timedelta(days=9), day), "three": (day - timedelta(days=3), day)}

    return DailyState(spark, str(folder), ["k"], {"scan": ["rows"], "three": ["rows", "n"]}, spans, present="scan")


def day_sums(spark, rows):
    return spark.createDataFrame(rows, "k string, on date, rows bigint, n bigint")


def test_a_new_load_date_needs_only_the_new_day(spark, tmp_path):
    state = small_state(spark, tmp_path / "s")
    hot = [("hot", plus(n), 3, 2**n) for n in range(10)]
    state.store_days(day_sums(spark, [*hot, ("gone", plus(1), 1, 5), (None, plus(8), 1, 6)]), "on", [plus(n) for n in range(10)])
    state.start(plus(10))
    # from here on the table of facts holds nothing but the new day
    state.store_days(day_sums(spark, [("hot", plus(10), 1, 1024), ("new", plus(10), 2, 1)]), "on", [plus(10)])
    rows = {r["k"]: (r["rows_scan"], r["rows_three"], r["n_three"]) for r in state.advance(plus(10), plus(11)).collect()}
    assert rows == {"hot": (25, 7, 256 + 512 + 1024), "new": (2, 2, 1), None: (1, 1, 6)}
    opened = state.days().where(F.col("day") == F.lit(plus(10)))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(day" in opened and "(day" in opened  # noqa: F541
    assert state.days().where(F.col("day") == F.lit(plus(10))).inputFiles()


def test_late_rows_and_emptied_days_are_restated(spark, tmp_path):
    state = small_state(spark, tmp_path / "s")
    state.store_days(day_sums(spark, [("a", plus(n), 1, 10) for n in range(10)]), "on", [plus(n) for n in range(10)])
    before = state.start(plus(10)).collect()
    state.store_days(day_sums(spark, [("a", plus(8), 2, 15), ("late", plus(8), 1, 1)]), "on", [plus(8), plus(9)])
    after = {r["k"]: (r["rows_scan"], r["rows_three"], r["n_three"]) for r in state.start(plus(10)).collect()}
    assert [(r["rows_scan"], r["rows_three"], r["n_three"]) for r in before] == [(9, 3, 30)]
    assert after == {"a": (9, 3, 25), "late": (1, 1, 1)}


def test_a_state_without_any_rows(spark, tmp_path):
    state = small_state(spark, tmp_path / "s")
    state.store_days(day_sums(spark, []), "on", [plus(n) for n in range(3)])
    assert state.start(plus(3)).count() == 0
    state.store_days(day_sums(spark, [("a", plus(3), 1, 1)]), "on", [plus(3)])
    assert [r["rows_scan"] for r in state.advance(plus(3), plus(4)).collect()] == [1]
