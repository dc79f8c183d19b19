"""Tables that cut lineage, in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.sources.folders import shared_folder


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share; see ``shared_folder`` where it is unset."""
    return shared_folder(spark)


# Spark removes the shuffle files of a query when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, keep_shuffles: bool = True) -> DataFrame:
    """``df`` as a stored table: computed once, read again after the loss of any executor.

    ``keep_shuffles=False`` is for large shuffles: their files go with the end of the write.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    if keep_shuffles:
        df.write.parquet(path)
    else:
        before = spark.conf.get(CLEANUP)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def dropped(table: DataFrame) -> None:
    """Remove a stored table that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id; rows that agree in both are copies of one document."""
    return F.xxhash64(text)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & left["text_key"].eqNullSafe(right["text_key"])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
