"""The newest row per key, kept from load date to load date without moving what is kept.

The state of a load date is a table bucketed and sorted by the key. New rows are cut to one per key and
meet it in a sort-merge join, for which only they are shuffled; each task then writes the bucket that it
read. A late row takes part like any other: it wins exactly where it would have won in a full run. The state of
a load date is written as a whole from that of an earlier one, so a step can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.operators.latest import first_per_key, newest_first

_KEY = "__key"


class LatestState:
    """One row per key with the greatest ``newest`` columns, NULLs last; NULL is a key like any other.

    ``newest`` must end in a unique column wherever the result has to be repeatable. ``buckets`` is also the
    number of tasks of a merge and should grow with the state.
    """

    def __init__(
        self, spark: SparkSession, name: str, folder: str, keys: Sequence[str], newest: Sequence[str], buckets: int = 200
    ):
        self._spark, self._name, self._folder = spark, name, folder.rstrip("/")
        self._keys, self._newest, self._buckets = list(keys), list(newest), buckets

    def start(self, rows: DataFrame, load_date: date) -> DataFrame:
        return self._stored(self._best(rows).repartition(self._buckets, _KEY), load_date)

    def merge(self, rows: DataFrame, before: date, load_date: date) -> DataFrame:
        """The state of ``before`` with new and late rows, as that of ``load_date``."""
        return self._stored(self.merged(rows, before), load_date)

    def merged(self, rows: DataFrame, before: date) -> DataFrame:
        held, new = self._table(before).alias("s"), self._best(rows).alias("n")
        same = F.col(f"s.{_KEY}") == F.col(f"n.{_KEY}")
        # A missing side is no row at all, which is less than a row of NULLs.
        wins = F.col(f"n.{_KEY}").isNotNull() & (F.col(f"s.{_KEY}").isNull() | (self._order("n") > self._order("s")))
        columns = [F.when(wins, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in new.columns]
        return held.join(new, same, "full").select(*columns)

    def rows(self, load_date: date) -> DataFrame:
        return self._table(load_date).drop(_KEY)

    def _order(self, side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in self._newest])

    def _best(self, rows: DataFrame) -> DataFrame:
        best = first_per_key(rows, self._keys, newest_first(*self._newest))
        # The key in one column that is never NULL, so that plain equality on the bucket column is the whole join.
        texts = [F.col(k).cast("string") for k in self._keys]
        parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
        return best.withColumn(_KEY, F.concat(*parts))

    def _place(self, load_date: date) -> tuple[str, str]:
        return f"{self._name}_{load_date:%Y%m%d}", f"{self._folder}/load_date={load_date}"

    def _table(self, load_date: date) -> DataFrame:
        """The stored state; another session only has to say again how its files are bucketed."""
        name, path = self._place(load_date)
        if not self._spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._spark.read.parquet(path).schema)
            self._spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) "
                f"INTO {self._buckets} BUCKETS LOCATION '{path}'"
            )
        return self._spark.table(name)

    def _stored(self, best: DataFrame, load_date: date) -> DataFrame:
        name, path = self._place(load_date)
        best.write.mode("overwrite").format("parquet").bucketBy(self._buckets, _KEY).sortBy(_KEY).option(
            "path", path
        ).saveAsTable(name)
        return self.rows(load_date)
