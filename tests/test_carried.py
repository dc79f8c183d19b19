"""State that is carried from load date to load date: newest row per key, numbered pairs."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sublens.operators.carried_pairs import CarriedPairs
from sublens.operators.latest import first_per_key, newest_first
from sublens.operators.latest_state import LatestState
from sublens.operators.ordered import paired_in_order
from tests.test_plans import plan_of

DAY0 = date(2024, 1, 1)


def plus(n: int) -> date:
    return DAY0 + timedelta(days=n)


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def no_broadcast(spark):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    yield
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


ROWS = "a string, b int, at int, id int, text string"


def newest_state(spark, tmp_path) -> LatestState:
    return LatestState(spark, f"state_{uuid.uuid4().hex}", str(tmp_path / "s"), ["a", "b"], ["at", "id"], buckets=4)


def some_rows(rng, n, first_id):
    return [
        (rng.choice(["hot", "hot", "x", "y", None]), rng.choice([1, 2, None]), rng.choice([None, rng.randrange(50)]), first_id + i, f"t{i}")
        for i in range(n)
    ]


def test_merged_days_and_late_rows_equal_a_full_run(spark, tmp_path):
    rng, state, every = random.Random(3), newest_state(spark, tmp_path), []
    for n in range(6):
        # ids go on, times do not: many rows are late
        new = some_rows(rng, 0 if n == 3 else 40, 1000 * n)
        every += new
        frame = spark.createDataFrame(new, ROWS)
        found = state.start(frame, plus(0)) if n == 0 else state.merge(frame, plus(n - 1), plus(n))
        full = first_per_key(spark.createDataFrame(every, ROWS), ["a", "b"], newest_first("at", "id"))
        assert as_rows(found) == as_rows(full)
    again = state.merge(spark.createDataFrame(some_rows(rng, 0, 0), ROWS), plus(4), plus(5))
    assert len(as_rows(again)) <= len(as_rows(full))


def test_the_state_is_not_shuffled(spark, tmp_path, no_broadcast):
    state = newest_state(spark, tmp_path)
    state.start(spark.createDataFrame(some_rows(random.Random(1), 50, 0), ROWS), plus(0))
    plan = plan_of(state.merged(spark.createDataFrame(some_rows(random.Random(2), 50, 100), ROWS), plus(0)))
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    above_scan = plan[: plan.index("FileScan")]
    held = above_scan[above_scan.index("SortMergeJoin") :]
    assert "Exchange" not in held and "Bucketed: true" in plan


def test_another_session_declares_the_stored_state_anew(spark, tmp_path):
    state = newest_state(spark, tmp_path)
    rows = as_rows(state.start(spark.createDataFrame(some_rows(random.Random(1), 30, 0), ROWS), plus(0)))
    other = LatestState(spark, f"state_{uuid.uuid4().hex}", str(tmp_path / "s"), ["a", "b"], ["at", "id"], buckets=4)
    assert as_rows(other.rows(plus(0))) == rows
    assert as_rows(other.merge(spark.createDataFrame([], ROWS), plus(0), plus(1))) == rows


EVENTS = "account int, service string, at timestamp_ntz, adds boolean"


def block_events(seed, days):
    rng = random.Random(seed)
    return [
        (
            rng.choice([7, 7, 7, 1, 2, None]),
            rng.choice(["p", "q", None]) if rng.random() < 0.2 else "p",
            datetime(2024, 1, 1) + timedelta(days=rng.randrange(days), minutes=rng.randrange(1440)),
            rng.random() < 0.5,
        )
        for _ in range(40 * days)
    ]


def test_thirty_chained_days_pair_like_one_full_run(spark, tmp_path):
    events = block_events(9, 30)
    every = spark.createDataFrame(events, EVENTS).cache()
    keys, adds = ["account", "service"], F.col("adds")
    state = CarriedPairs(spark, str(tmp_path / "pairs"), keys, "added", "removed")

    def known(until, since=None):
        rows = every.where(F.col("at") < F.lit(until).cast("timestamp_ntz"))
        return rows if since is None else rows.where(F.col("at") >= F.lit(since).cast("timestamp_ntz"))

    found = state.start(known(plus(3)), "at", adds, plus(3))
    for n in range(4, 31):
        if n == 20:
            continue  # a day that was left out is taken in with the next one
        before = plus(n - 1) if n != 21 else plus(19)
        found = state.advance(known(plus(n), before), "at", adds, before, plus(n))
        if n in (4, 21, 30):
            full = paired_in_order(known(plus(n)), keys, "at", adds, "added", "removed")
            assert as_rows(found) == as_rows(full.select(found.columns))
    again = state.advance(known(plus(30), plus(29)), "at", adds, plus(29), plus(30))
    assert as_rows(again) == as_rows(full.select(found.columns))


def test_pairs_of_no_events(spark, tmp_path):
    state = CarriedPairs(spark, str(tmp_path / "pairs"), ["account", "service"], "added", "removed")
    none = spark.createDataFrame([], EVENTS)
    assert state.start(none, "at", F.col("adds"), plus(1)).count() == 0
    one = spark.createDataFrame([(1, "p", datetime(2024, 1, 2), True)], EVENTS)
    assert [r["removed"] for r in state.advance(one, "at", F.col("adds"), plus(1), plus(2)).collect()] == [None]
