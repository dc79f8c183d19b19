"""What the plans of the training-data queries must not hold."""

import pytest

from sublens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Queries that only use SQL functions on their main path.
NATIVE = ("op2_", "op6_", "op8_", "op13_")
# Broadcasts asked for by a hint, and what bounds them: a bitmap of hashed ids of at most 8 MB, and the
# keys above a share of the table, of which there are few at any size.
HINTED = {"op4_suffix_dedup": "bits", "op6_line_dedup": "owner", "op9_jaccard_join": "bits"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    yield
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith("op")))
def test_no_operator_pairs_everything_or_needs_a_broadcast_that_grows(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "BroadcastHashJoin" in line:
            assert name in HINTED and HINTED[name] in line, line
    if name.startswith(NATIVE):
        for python in ("PythonUDF", "InPandas", "InArrow", "mapPartitions"):
            assert python not in plan
