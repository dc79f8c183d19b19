"""What the physical plans of all queries must and must not hold."""

import re

import pytest

from __spark_entry__ import LIBRARY, oracle_sql, queries
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(name for family in LIBRARY for name in family.QUERIES)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_no_query_needs_a_broadcast_or_an_all_pairs_join(spark, no_broadcast, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "PythonUDF", "InPandas"):
        assert forbidden not in plan


@pytest.mark.parametrize("name", NAMES)
def test_single_partitions_only_hold_scalar_aggregates(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[]" in lines[number + 1]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("payment_windows", "GreaterThanOrEqual(o_orderdate,1998-04-15T00:00)"),
        ("recharge_counts", "LessThan(o_orderdate,1998-07-15T00:00)"),
        ("usage_windows", "GreaterThanOrEqual(l_shipdate,1998-04-16T00:00)"),
        ("call_ratio", "GreaterThanOrEqual(l_shipdate,1998-06-15T00:00)"),
        ("plan_slots", "GreaterThanOrEqual(o_orderdate,1997-06-15T00:00)"),
        ("roaming_trips", "GreaterThanOrEqual(ts,2023-07-24T00:00)"),
        ("loyalty_points", "GreaterThanOrEqual(ts,2023-12-26T00:00)"),
        ("number_status", "ts"),
    ],
)
def test_date_windows_reach_the_scan(spark, name, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = plan_of(queries()[name](spark, SF_DIR))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert any(pushed in f for f in filters), filters


@pytest.mark.parametrize("name", ["latest_block", "survey_latest", "loyalty_tier", "sharing_balance", "score_latest"])
def test_top_one_is_limited_before_the_exchange(spark, name):
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plan_of(queries()[name](spark, SF_DIR)))


@pytest.mark.parametrize(
    "name", ["status", "plan_report", "service_pivot", "payment_windows", "interval_join", "roaming_trips", "termination_date"]
)
def test_sort_merge_joins_give_the_same_rows(spark, no_broadcast, name):
    con = connect(SF_DIR)
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []
    con.close()


@pytest.mark.parametrize("name", ["payment_windows", "last_method", "payment_reruns", "usage_reruns", "booster_reruns"])
def test_newest_rows_of_facts_come_from_hash_aggregates(spark, no_broadcast, name):
    assert "SortAggregate" not in plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["roaming_trips", "country_changes"])
def test_only_lookups_are_collapsed_by_sorting(spark, no_broadcast, name):
    # the greatest name per network and the account of a number; messages are never sorted for their newest
    sorting = [line for line in plan_of(queries()[name](spark, SF_DIR)).splitlines() if "SortAggregate" in line]
    assert all("max(country#" in line or "max(IN_ACCOUNT_NUMBER#" in line for line in sorting), sorting


def sorts_of_stages(plan: str) -> list[int]:
    """How many sorts the tasks of each stage hold: nodes with no exchange between them are one stage."""
    above, sorts = [], [0]
    for line in plan.splitlines():
        found = re.match(r"[\s:+-]*(\(\d+\) )?", line)
        depth, node = len(found[0]), line[found.end() :]
        above = [(d, stage) for d, stage in above if d < depth]
        stage = above[-1][1] if above else 0
        if node.startswith("Sort "):
            sorts[stage] += 1
        if node.startswith("Exchange"):
            stage = len(sorts)
            sorts.append(0)
        above.append((depth, stage))
    return sorts


@pytest.mark.parametrize("name", ["status_all_answers", "status", "acquisition", "demographics"])
def test_no_task_holds_the_sorts_of_the_base_and_of_all_joins_to_it(spark, no_broadcast, name):
    assert max(sorts_of_stages(plan_of(queries()[name](spark, SF_DIR)))) <= 6
