"""Operators against plain windows, plain joins or brute force, with hot keys and missing values."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sublens.operators.joins import aligned_blocks, interval_join, not_in, repeat_rows, with_existence
from sublens.operators.latest import collapse, duplicated_keys, first_per_key, latest_refresh
from sublens.operators.ordered import numbered_in_order, paired_in_order, previous_in_order


def test_first_per_key_puts_missing_last_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", None, 9), ("b", None, 1), (None, 3, 3)], "k string, o int, v int"
    )
    newest = first_per_key(df, ["k"], [F.desc_nulls_last("o"), F.desc("v")])
    assert rows(newest) == [("a", 2, 5), ("b", None, 1), (None, 3, 3)]


def test_first_per_key_limits_rows_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange") :] and "WindowGroupLimit" in plan


def test_latest_refresh_ignores_later_dates(spark, rows):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2024, 1, 3)), (3, date(2024, 1, 3)), (4, date(2024, 1, 9)), (5, None)],
        "v int, d date",
    )
    assert rows(latest_refresh(df, "d", date(2024, 1, 9)), "v") == [(2,), (3,)]
    assert rows(latest_refresh(df, "d", date(2023, 1, 1)), "v") == []


def test_collapse_and_audit(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "k string, v int")
    assert rows(collapse(df, "k", top="v")) == [("a", 3), ("b", None)]
    assert rows(duplicated_keys(df, "k")) == [("a", 2)]


@pytest.mark.parametrize(
    "left, right, kept",
    [
        ([1, 2, None], [2], [1]),
        ([1, 2, None], [], [1, 2, None]),
        ([1, 2, None], [2, None], []),
        ([1, 1, 2], [2, 2], [1, 1]),
    ],
)
def test_not_in_follows_three_valued_logic(spark, rows, left, right, kept):
    df = spark.createDataFrame([(v,) for v in left], "x int")
    keys = spark.createDataFrame([(v,) for v in right], "y int")
    assert rows(not_in(df, "x", keys)) == [(v,) for v in kept]
    df.createOrReplaceTempView("l")
    keys.createOrReplaceTempView("r")
    assert rows(spark.sql("select x from l where x not in (select y from r)")) == [(v,) for v in kept]


def test_with_existence_never_repeats_rows(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(with_existence(df, keys, "k", "f", "yes", "no")) == [(1, "yes"), (2, "no"), (None, "no")]


def test_repeat_rows_across_blocks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", None), ("d", 8)], "k string, n int")
    repeated = repeat_rows(df, "n", block=4)
    assert repeated.columns == ["k"]
    assert rows(repeated.groupBy("k").count()) == [("a", 1), ("b", 10), ("c", 1), ("d", 8)]


def _events(seed=3, n=400):
    """One key holds a third of all rows; some keys are missing."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (
            1 if rng.random() < 0.33 else rng.choice([2, 3, 4, 5, None]),
            i,
            rng.choice(["x", "y", None]),
            start + timedelta(hours=7 * i),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("block", [1, 7, 50, 10_000])
def test_previous_in_order_equals_lag(spark, rows, block):
    df = spark.createDataFrame(_events(), "k int, id int, v string, at timestamp_ntz")
    ours = previous_in_order(df, ["k"], ["id"], F.floor(F.col("id") / block), {"p": "v", "pid": "id"})
    window = Window.partitionBy("k").orderBy("id")
    plain = df.withColumns({"p": F.lag("v").over(window), "pid": F.lag("id").over(window)})
    columns = ["k", "id", "v", "p", "pid"]
    assert rows(ours, *columns) == rows(plain, *columns)


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_numbered_in_order_equals_row_number(spark, rows, block):
    df = spark.createDataFrame(_events(), "k int, id int, v string, at timestamp_ntz")
    ours = numbered_in_order(df, ["k", "v"], ["id"], F.floor(F.col("id") / block), "n")
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "v").orderBy("id")))
    columns = ["k", "id", "v", "n"]
    assert rows(ours, *columns) == rows(plain, *columns)


def test_ordered_work_is_spread_by_bucket(spark):
    df = spark.createDataFrame(_events(), "k int, id int, v string, at timestamp_ntz")
    plan = previous_in_order(df, ["k"], ["id"], F.floor(F.col("id") / 7), {"p": "v"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    assert text.count("hashpartitioning(k") == 3


def test_paired_in_order(spark, rows):
    at = lambda d: datetime(2024, 1, d)
    df = spark.createDataFrame(
        [
            (1, True, at(1)), (1, True, at(5)), (1, False, at(3)),
            (2, False, at(2)), (3, True, at(4)), (None, True, at(1)), (None, False, at(2)),
        ],
        "k int, opens boolean, at timestamp_ntz",
    )
    pairs = paired_in_order(df, ["k"], "at", F.col("opens"), "a", "b")
    assert rows(pairs, "k", "a", "b") == [
        (1, at(1), at(3)), (1, at(5), None), (3, at(4), None), (None, at(1), None),
    ]


@pytest.mark.parametrize("bucket_days, levels", [(1, 8), (1, 2), (5, 3), (5, 0), (400, 1)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_equals_range_join(spark, rows, bucket_days, levels, how):
    rng = random.Random(11)
    day = lambda: datetime(2024, 1, 1) + timedelta(days=rng.randrange(120), hours=rng.choice([0, 0, 13]))
    key = lambda: 1 if rng.random() < 0.4 else rng.choice([2, 3, None])
    points = [(key(), i, day()) for i in range(120)]
    intervals = [(key(), i, day(), day()) for i in range(60)]
    left = spark.createDataFrame(points, "k int, pid int, at timestamp_ntz")
    right = spark.createDataFrame(intervals, "k int, iid int, lo timestamp_ntz, hi timestamp_ntz")
    joined = interval_join(left, right, ["k"], F.col("at"), "lo", "hi", how, bucket_days, levels)
    expected = []
    for k, pid, at in points:
        hits = [(k, pid, iid) for k2, iid, lo, hi in intervals if k is not None and k == k2 and lo <= at < hi]
        expected += hits or ([(k, pid, None)] if how == "left" else [])
    assert rows(joined, "k", "pid", "iid") == sorted(
        expected, key=lambda t: tuple((v is None, str(v)) for v in t)
    )


def test_aligned_blocks_are_few_and_hold_each_number_once(spark):
    rng = random.Random(4)
    spans = [(a, a + rng.randrange(1, 600)) for a in (rng.randrange(-400, 400) for _ in range(150))] + [(0, 8192), (-1, 1)]
    df = spark.createDataFrame(spans, "a int, b int")
    for r in df.select("a", "b", aligned_blocks(F.col("a"), F.col("b"), 9).alias("blocks")).collect():
        held = [n for k, b in r["blocks"] for n in range(b << k, (b + 1) << k)]
        assert sorted(held) == list(range(r["a"], r["b"]))
        small = [k for k, _ in r["blocks"] if k < 9]
        assert all(small.count(k) <= 2 for k in small) and len(r["blocks"]) - len(small) <= (r["b"] - r["a"]) >> 9


def test_interval_join_of_a_hot_key_with_long_intervals(spark):
    # one key with all points, blocks of twenty years and of hours, equal points on many rows
    points = spark.range(4000).select(
        F.lit(1).alias("k"), "id", F.expr("timestamp_ntz '2004-01-01' + make_dt_interval(cast(id % 1000 as int) * 7)").alias("at")
    )
    intervals = spark.createDataFrame(
        [(1, 1, datetime(2001, 5, 5), datetime(2021, 5, 5)), (1, 2, datetime(2010, 1, 1), datetime(2010, 1, 2)), (2, 3, datetime(2000, 1, 1), datetime(2022, 1, 1))],
        "k int, iid int, lo timestamp_ntz, hi timestamp_ntz",
    )
    found = interval_join(points, intervals, ["k"], F.col("at"), "lo", "hi")
    expected = points.alias("p").join(
        intervals.alias("i"), F.expr("p.k = i.k and p.at >= i.lo and p.at < i.hi"), "left"
    ).select("p.k", "id", "iid")
    assert sorted(map(str, found.select("k", "id", "iid").collect())) == sorted(map(str, expected.collect()))
    assert interval_join(points, intervals.limit(0), ["k"], F.col("at"), "lo", "hi").where("iid is null").count() == 4000


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    df = spark.createDataFrame([("hot", 4096 * 64), ("a", 1), ("b", None)], "k string, times bigint")
    made = repeat_rows(df, "times").groupBy("k", F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in made) == 4096 * 64 + 2
    shares = [r["count"] for r in made if r["k"] == "hot"]
    assert len(shares) > 4 and max(shares) < 4096 * 64 // 3
