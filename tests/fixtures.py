"""Hand-made source tables: rows as dicts, columns left out are NULL, tables left out are empty."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

from sublens.sources.schemas import SCHEMAS
from sublens.sources.tables import Tables


def _fitting(value, kind: T.DataType):
    """Whole numbers may stand for amounts."""
    return Decimal(value) if isinstance(kind, T.DecimalType) and isinstance(value, int) else value


class HandMade(Tables):
    def __init__(self, spark, **rows: list[dict]):
        super().__init__()
        self._spark, self._rows = spark, rows

    def load(self, name: str):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        data = [tuple(_fitting(row.get(f.name), f.dataType) for f in schema) for row in self._rows.get(name, [])]
        for row in self._rows.get(name, []):
            unknown = set(row) - {f.name for f in schema}
            assert not unknown, f"{name} has no column {unknown}"
        return self._spark.createDataFrame(data, schema)
