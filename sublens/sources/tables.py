"""Table resolvers: a name of the data model in, a DataFrame with the declared types out.

A pipeline only ever asks ``tables["name"]``. Catalog tables may sit in any schema (two- or
three-part names), parquet tables in any directory; a table partitioned by its date column gets
partition pruning from the pipelines' date filters.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.load_date import LoadDate
from sublens.sources.schemas import HISTORIES, SCHEMAS


@lru_cache(maxsize=None)
def declared_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns, casting each once and only where the type differs.

    A value that does not fit the declared type becomes NULL, as in a lenient warehouse load.
    """
    declared = declared_schema(name)
    present = {f.name.lower(): f for f in df.schema.fields}
    missing = [f.name for f in declared if f.name.lower() not in present]
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(missing)}")
    columns = []
    for field in declared:
        found = present[field.name.lower()]
        column = F.col(f"`{found.name}`")
        if found.dataType != field.dataType:
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Tables:
    """Base resolver: opens and conforms each table at most once per instance."""

    def __init__(self):
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = conform(self.load(name), name)
        return self._opened[name]

    def history(self, name: str, load_date) -> DataFrame:
        """A dated table as it stood at the load date. The cut is a plain filter that reaches the scan."""
        day = LoadDate.of(load_date)
        column, closed = HISTORIES[name]
        table = self[name]
        known = F.col(column)
        if isinstance(table.schema[column].dataType, T.StringType):
            known = known.try_cast("timestamp_ntz")
        edge = F.lit(day.back(-1) if closed else day.day)
        if not isinstance(table.schema[column].dataType, T.DateType):
            edge = edge.cast("timestamp_ntz")
        return table.where((known < edge) | known.isNull())

    def load(self, name: str) -> DataFrame:
        raise NotImplementedError


class FrameTables(Tables):
    """Tables held as DataFrames, for tests and for data prepared by other Spark jobs."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        super().__init__()
        self._frames = dict(frames)

    def load(self, name: str) -> DataFrame:
        return self._frames[name]


class ParquetTables(Tables):
    """One parquet table (file or directory) per name under a root path."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet"):
        super().__init__()
        self._spark, self._root, self._suffix = spark, root.rstrip("/"), suffix

    def load(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._root}/{name}{self._suffix}")


class CatalogTables(Tables):
    """Tables of the session catalog; ``locations`` maps a name to its catalog and schema."""

    def __init__(self, spark: SparkSession, schema: str, locations: Mapping[str, str] | None = None):
        super().__init__()
        self._spark, self._schema, self._locations = spark, schema, dict(locations or {})

    def load(self, name: str) -> DataFrame:
        return self._spark.table(f"{self._locations.get(name, self._schema)}.`{name}`")
