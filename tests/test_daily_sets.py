"""Sets of values carried from day to day and distinct counts of many load dates, against counting anew."""

import random
import re
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks.binding import EVENTS_L, events_tables
from checks.compare import connect, differences
from sublens.load_date import add_months
from sublens.operators.daily_sets import WORD, DailySets, _pieces, distinct_over_dates
from sublens.operators.rolling import DateList
from sublens.plans import engagement
from tests.test_plans import SF_DIR, plan_of

START = date(2024, 1, 1)
DAYS = 100


def plus(n: int) -> date:
    return START + timedelta(days=n)


def windows_of(day: date):
    return {"week": (day - timedelta(days=7), day), "long": (add_months(day, -3), day)}


def some_rows(seed: int, count: int = 500) -> list[tuple]:
    rng = random.Random(seed)
    values = [f"v{n:03}" for n in range(3 * WORD)] + [None]
    return [(rng.choice(["hot", "hot", "a", None]), rng.choice(values), plus(rng.randrange(DAYS))) for _ in range(count)]


def counted(rows, day: date) -> dict:
    """Distinct values per key and window by plain sets."""
    found = {}
    for window, (start, end) in windows_of(day).items():
        for key, value, on in rows:
            if value is not None and start <= on < end:
                found.setdefault(key, {}).setdefault(window, set()).add(value)
    return {key: tuple(len(by.get(w, ())) for w in windows_of(day)) for key, by in found.items()}


@pytest.fixture
def state(spark, tmp_path):
    return DailySets(spark, str(tmp_path / uuid.uuid4().hex), ["k"], "v", windows_of)


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, on date")


def counts(state, day: date) -> dict:
    return {r["k"]: (r["n_week"], r["n_long"]) for r in state.counts(day).collect()}


def test_sets_of_stored_days_and_months_count_like_the_rows(spark, state):
    rows = some_rows(1)
    state.store_days(table(spark, rows), "on", [plus(n) for n in range(95)])
    state.store_days(table(spark, rows), "on", [plus(95), plus(96)])
    assert state._whole_months() == {date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)}
    for day in (plus(97), plus(60), plus(31)):
        assert counts(state, day) == counted(rows, day)
    members = {(r["k"], r["value"]): (r["in_week"], r["in_long"]) for r in state.members(plus(97)).collect()}
    (week, behind), (quarter, _) = windows_of(plus(97)).values()
    want = {(k, v) for k, v, on in rows if v is not None and quarter <= on < behind}
    assert set(members) == want
    assert {pair for pair, held in members.items() if held[0]} == {(k, v) for k, v, on in rows if v and week <= on < behind}


def test_late_rows_and_repeated_steps_and_new_values(spark, state):
    rows = some_rows(2, 80)
    state.store_days(table(spark, rows), "on", [plus(n) for n in range(90)])
    before = {r["value"]: r["number"] for r in state.values().collect()}
    # a day of a closed month loses its rows and gets others, with a value never seen before
    late = [row for row in rows if row[2] != plus(40)] + [("a", "w", plus(40)), ("late", "w", plus(40)), ("late", "w", plus(40))]
    for _ in range(2):
        state.store_days(table(spark, late), "on", [plus(40)])
    for day in (plus(90), plus(45)):
        assert counts(state, day) == counted(late, day)
    after = {r["value"]: r["number"] for r in state.values().collect()}
    assert before.items() <= after.items() and sorted(after.values()) == list(range(len(after)))


def test_empty_days(spark, state):
    state.store_days(table(spark, []), "on", [plus(0), plus(1)])
    assert counts(state, plus(2)) == {}
    state.store_days(table(spark, [("a", None, plus(2)), ("a", "x", plus(3))]), "on", [plus(2), plus(3)])
    assert counts(state, plus(3)) == {} and counts(state, plus(4)) == {"a": (1, 1)}


def test_distinct_counts_of_irregular_dates_equal_counting_each(spark):
    rows = some_rows(3) + [("edge", "x", plus(10)), ("edge", "x", plus(10)), ("edge", "x", plus(17)), ("edge", "y", plus(24))]
    asked = [plus(n) for n in (35, 10, 11, 12, 17, 18, 24, 25, 99, 60, 61, 11)]
    found = distinct_over_dates(table(spark, rows), ["k"], "v", "on", DateList(asked, windows_of))
    got = {(r["k"], r["load_date"]): (r["n_week"], r["n_long"]) for r in found.collect()}
    assert found.count() == len(got)
    assert got == {(k, day): both for day in set(asked) for k, both in counted(rows, day).items()}
    empty = distinct_over_dates(table(spark, []), ["k"], "v", "on", DateList(asked, windows_of))
    assert empty.collect() == []


def test_a_report_reads_no_messages_and_few_days(spark, tmp_path):
    tables = events_tables(spark, SF_DIR)
    state = engagement.network_state(spark, str(tmp_path / "networks"))
    start = min(first for first, _ in engagement.roaming_windows(EVENTS_L).values())
    engagement.store_networks(tables, state, start, EVENTS_L)
    report = engagement.countries_from(tables, state, EVENTS_L)
    plan = plan_of(report)
    assert "events.parquet" not in plan
    assert re.search(r"PartitionFilters: \[.*day#\d+ IN|PartitionFilters: \[.*day#\d+ INSET", plan)
    assert state._whole_months() == {date(2023, n, 1) for n in (7, 8, 9, 10, 11, 12)}
    months, days = _pieces(engagement.roaming_windows(EVENTS_L)["6M"], state._whole_months())
    assert len(months) == 5 and len(days) == 8 + 24
    trips = engagement.roaming_trips(tables, EVENTS_L).select("MSISDN", "RLH_UNIQUE_COUNTRY_6M")
    assert sorted(trips.collect()) == sorted(report.select("MSISDN", "RLH_UNIQUE_COUNTRY_6M").collect())


def test_sets_are_united_by_hash_aggregates(spark, state):
    state.store_days(table(spark, some_rows(4, 50)), "on", [plus(n) for n in range(40)])
    assert "SortAggregate" not in plan_of(state.counts(plus(40)))


@pytest.mark.parametrize("name", ["countries_reruns", "countries_day_by_day"])
def test_queries_agree_with_their_oracles(spark, name):
    from __spark_entry__ import oracle_sql, queries

    con = connect(SF_DIR)
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []
    con.close()
