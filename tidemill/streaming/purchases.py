"""Purchase streams: continuous ingest into an append-only table, and running hourly volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.schemas import LAYOUTS, conform
from tidemill.sources.journal import Journal, Merged, Part, observed_write
from tidemill.streaming.runner import land_batches, with_event_time

PREFIX = "batch="
_TABLE = "olap.purchases"


def journal(spark: SparkSession, path: str) -> Journal:
    return Journal(spark, path, PREFIX)


def ingest_append(purchases: DataFrame, path: str, checkpoint: str) -> str:
    """Append every version of every purchase, each file sorted by item and time so that scans can skip row groups.

    A micro-batch writes its own folder, named after its checkpoint's run and its number: replaying it after a failure
    replaces that folder, and another checkpoint writes next to it, so no row is lost or doubled. A lost checkpoint that
    delivers the same batches again adds nothing.
    """
    plan = LAYOUTS[_TABLE]

    def write(batch: DataFrame, target: str, part: Part) -> str:
        return observed_write(conform(batch, plan.schema).sortWithinPartitions(*plan.sort), target)

    land_batches(purchases, journal(purchases.sparkSession, path), write, checkpoint)
    return path


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every purchase that has been ingested; an empty table if none has."""
    log, schema = journal(spark, path), LAYOUTS[_TABLE].schema
    parts, merged = log.live()
    paths = [log.path(p) for p in [*merged, *parts]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_ingested(spark: SparkSession, path: str) -> Merged | None:
    """Write the small files of many batches as one sorted part, which stands for them; None if there is one part at most."""
    log, plan = journal(spark, path), LAYOUTS[_TABLE]
    parts, merged = log.live()
    if len(parts) + len(merged) < 2:
        return None
    rows = read_ingested(spark, path).hint("rebalance", plan.sort[0]).sortWithinPartitions(*plan.sort)
    return log.merge(parts, merged, rows.write.mode("overwrite").parquet)


def stream_hourly_volume(purchases: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Quantity sold per hour without deleted purchases, each hour emitted when it is over."""
    timed = purchases.withColumn("event_time", F.col("created_at"))
    kept = with_event_time(timed, "event_time", delay).where(~F.col("deleted"))
    hourly = kept.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.sum("quantity").alias("total_sales"))
    return hourly.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "total_sales")
