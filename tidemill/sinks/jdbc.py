"""Writing to operational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(url: str, table: str, batch_size: int = 10_000, connections: int = 16, **extra: str) -> dict:
    """Writer options: truncate instead of drop keeps the target's keys and types, and connections are limited."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **extra: str) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **extra)).mode(mode).save()
