"""Operational tables over JDBC, read in parallel key ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.schemas import conform


@dataclass(frozen=True)
class KeyRange:
    """A numeric or date column to cut the scan by. The bounds shape the cut only; no row outside them is lost."""

    column: str
    lower: object
    upper: object
    partitions: int


def jdbc_read_options(url: str, table: str, cut: KeyRange | None = None, fetch_size: int = 10_000, **extra: str) -> dict:
    """Reader options for a table, or for a sub-query written as ``(select ..) t``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownPredicate": "true", **extra}
    if cut is not None:
        options |= {
            "partitionColumn": cut.column,
            "lowerBound": str(cut.lower),
            "upperBound": str(cut.upper),
            "numPartitions": str(cut.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, schema: T.StructType, cut: KeyRange | None = None, **extra: str
) -> DataFrame:
    """Scan a table and keep the declared columns, cast. Without a ``cut`` the scan is a single connection."""
    return conform(spark.read.format("jdbc").options(**jdbc_read_options(url, table, cut, **extra)).load(), schema)


def key_range(spark: SparkSession, url: str, table: str, column: str, partitions: int, **extra: str) -> KeyRange | None:
    """Ask the database for the column's extremes; None for an empty table."""
    query = f"(select min({column}) as low, max({column}) as high from {table}) extremes"
    row = spark.read.format("jdbc").options(**jdbc_read_options(url, query, **extra)).load().first()
    low, high = row[0], row[1]
    return None if low is None else KeyRange(column, low, high, partitions)
