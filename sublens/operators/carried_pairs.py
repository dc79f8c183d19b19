"""Pairs of openings and closings, carried from load date to load date.

``paired_in_order`` numbers all events of a key to pair the n-th opening with the n-th closing. Here the numbers
go on from day to day: what is kept per key is how many openings and closings there were and which of them still
wait for their partner, so a load date reads its new events only. Pairs that are complete are written once,
under the load date that completed them.

An event must not be older than the load date up to which events were taken in; with late events the keys they
belong to have to be started again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.operators.ordered import numbered_in_order


class CarriedPairs:
    """Pairs in a folder: ``pairs`` by load date, and per load date the ``counts`` and ``waiting`` events."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], opened_at: str, closed_at: str):
        self._spark, self._folder, self._keys = spark, folder.rstrip("/"), list(keys)
        self._opened_at, self._closed_at = opened_at, closed_at

    def start(self, events: DataFrame, at: str, opens: Column, load_date: date) -> DataFrame:
        """Take in all events so far."""
        return self._taken(events, at, opens, None, load_date)

    def advance(self, events: DataFrame, at: str, opens: Column, before: date, load_date: date) -> DataFrame:
        """Take in the events from ``before`` on."""
        return self._taken(events, at, opens, before, load_date)

    def pairs(self, load_date: date) -> DataFrame:
        """Keys, opening, closing of all pairs up to a load date; an opening still waiting has no closing."""
        complete = self._spark.read.parquet(f"{self._folder}/pairs").where(F.col("load_date") <= F.lit(load_date))
        columns = [*self._keys, self._opened_at, self._closed_at]
        still_open = self._read("waiting", load_date).where("opens").select(
            *self._keys, F.col("at").alias(self._opened_at), F.lit(None).alias(self._closed_at)
        )
        return complete.select(*columns).unionByName(still_open)

    def _taken(self, events: DataFrame, at: str, opens: Column, before: date | None, load_date: date) -> DataFrame:
        whole_key = F.lit(True)
        for key in self._keys:
            whole_key = whole_key & F.col(key).isNotNull()
        # A closing without a key closes nothing.
        marked = events.select(*self._keys, F.col(at).alias("at"), opens.alias("opens")).where(F.col("opens") | whole_key)
        bucket = F.date_trunc("month" if before is None else "hour", "at")
        new = numbered_in_order(marked, [*self._keys, "opens"], ["at"], bucket, "n")
        counts = new.groupBy(*self._keys).agg(
            F.count_if("opens").alias("openings"), F.count_if(~F.col("opens")).alias("closings")
        )
        if before is not None:
            known = self._read("counts", before)
            both = new.alias("e").join(known.alias("k"), self._same("e", "k"), "left")
            earlier = F.when(F.col("e.opens"), F.col("k.openings")).otherwise(F.col("k.closings"))
            new = both.select(
                *[F.col(f"e.{k}") for k in self._keys], "e.at", "e.opens", (F.col("e.n") + F.coalesce(earlier, F.lit(0))).alias("n")
            )
            new = new.unionByName(self._read("waiting", before))
            counts = counts.unionByName(known).groupBy(*self._keys).agg(
                F.sum("openings").alias("openings"), F.sum("closings").alias("closings")
            )
        met = new.groupBy(*self._keys, "n").agg(
            F.max(F.when(F.col("opens"), F.col("at"))).alias("opening"),
            F.max(F.when(~F.col("opens"), F.col("at"))).alias("closing"),
        )
        self._write("counts", counts, load_date)
        self._write("met", met, load_date)
        met = self._read("met", load_date)
        complete = F.col("opening").isNotNull() & F.col("closing").isNotNull()
        self._write(
            "pairs",
            met.where(complete).select(
                *self._keys, F.col("opening").alias(self._opened_at), F.col("closing").alias(self._closed_at)
            ),
            load_date,
        )
        self._write(
            "waiting",
            met.where(~complete).select(
                *self._keys, F.coalesce("opening", "closing").alias("at"), F.col("opening").isNotNull().alias("opens"), "n"
            ),
            load_date,
        )
        return self.pairs(load_date)

    def _same(self, left: str, right: str) -> Column:
        same = F.lit(True)
        for key in self._keys:
            same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
        return same

    def _write(self, table: str, rows: DataFrame, load_date: date) -> None:
        rows.write.mode("overwrite").parquet(f"{self._folder}/{table}/load_date={load_date}")

    def _read(self, table: str, load_date: date) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{table}/load_date={load_date}")
