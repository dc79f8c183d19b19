"""Subscriber feature engine: daily per-account features of a mobile operator, on Spark DataFrames.

Every feature family is a plain function ``(tables, load_date) -> DataFrame``.
"""

from sublens.load_date import LoadDate
from sublens.sources.tables import CatalogTables, FrameTables, ParquetTables

__all__ = ["CatalogTables", "FrameTables", "LoadDate", "ParquetTables"]
