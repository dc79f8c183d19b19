"""Table resolvers, declared types and partition pruning."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sublens.plans.customer_base import departed_accounts, number_states
from sublens.sources.schemas import SCHEMAS
from sublens.sources.tables import CatalogTables, FrameTables, ParquetTables, declared_schema


def test_conform_casts_by_name_and_turns_misfits_into_null(spark, rows):
    raw = spark.createDataFrame(
        [("7", "Open", "2023-01-02", "x"), ("bad", None, "never", "y")],
        "ACCOUNTNUM string, historytypekey string, tstamp string, extra string",
    ).withColumn("additionalinfo", F.lit(None).cast("string"))
    history = FrameTables({"nobill_tx_phonenumber_history": raw})["nobill_tx_phonenumber_history"]
    assert history.schema == declared_schema("nobill_tx_phonenumber_history")
    assert rows(history, "accountnum", "historytypekey") == [(7, "Open"), (None, None)]
    assert [r[0] is None for r in history.orderBy(F.desc_nulls_last("accountnum")).select("tstamp").collect()] == [False, True]


def test_missing_columns_are_named(spark):
    tables = FrameTables({"loy_tier": spark.range(1)})
    with pytest.raises(ValueError, match="loy_tier lacks the columns name_en"):
        tables["loy_tier"]


def test_tables_are_opened_once(spark):
    tables = FrameTables({"nobill_dim_termzone": spark.range(3).withColumnRenamed("id", "dtz_termzone_id")})
    assert tables["nobill_dim_termzone"] is tables["nobill_dim_termzone"]


def test_catalog_tables_use_their_schema(spark, rows):
    spark.createDataFrame([(1, "Gold")], "ID int, name_en string").createOrReplaceGlobalTempView("loy_tier")
    assert rows(CatalogTables(spark, "global_temp")["loy_tier"]) == [(1, "Gold")]
    assert rows(CatalogTables(spark, "elsewhere", {"loy_tier": "global_temp"})["loy_tier"]) == [(1, "Gold")]


def test_declared_types_parse():
    for name in SCHEMAS:
        assert declared_schema(name).fields


def test_date_partitions_are_pruned(spark, tmp_path, rows):
    load = date(2023, 6, 15)
    data = [(a, "n", 3, 0, load - timedelta(days=d), "VM_Standard") for a, d in [(1, 1), (2, 30), (3, 200)]]
    frame = spark.createDataFrame(data, declared_schema("nobill_snapshot_subscription"))
    frame.write.partitionBy("snapshotdate").parquet(str(tmp_path / "nobill_snapshot_subscription"))
    tables = ParquetTables(spark, str(tmp_path), suffix="")
    for result, expected in [
        (number_states(tables, load).select("accountnum"), [(1,)]),
        (departed_accounts(tables, load), [(2,)]),
    ]:
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshotdate" in plan
        assert rows(result) == expected
