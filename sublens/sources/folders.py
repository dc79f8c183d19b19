"""Where a pipeline keeps tables of its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset and everything runs in one process, a folder of this machine will do; on a cluster that
    would lose data, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="sublens-"))
    return _LOCAL[0]
