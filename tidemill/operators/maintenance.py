"""Table upkeep with its guard: tables that are missing or empty are left alone."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemill.sinks.tables import RunReport, compact
from tidemill.sources.tables import is_ready, read_layer, table_path
from tidemill.sources.versions import expire


def compact_if_ready(spark: SparkSession, root: str, layer: str, name: str, target_mb: int = 256) -> RunReport | None:
    if not is_ready(lambda: read_layer(spark, root, layer, name)):
        return None
    return compact(spark, root, layer, name, target_mb)


def drop_old_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> list[str]:
    """Free the space of replaced versions, all but the newest ``keep``."""
    return expire(spark, table_path(root, layer, name), keep)
