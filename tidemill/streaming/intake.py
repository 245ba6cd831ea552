"""Taking events in: good rows, rows that come too late and lines that do not parse go to tables of their own.

A row is late if its event time lies more than ``delay`` before the newest one that earlier batches brought. The batches'
newest times are kept next to their rows, so a batch that is replayed, or a stream that is restarted, judges as before. Rows without
an event time are never late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.events import CORRUPT
from tidemill.sources.journal import Journal, Part, observed_write
from tidemill.streaming.runner import land_batches

PREFIX = "batch-"
KINDS = ("rows", "late", "bad")
_KIND = "__kind"


def journal(spark: SparkSession, root: str) -> Journal:
    return Journal(spark, root, PREFIX)


def _newest(spark: SparkSession, log: Journal, column: str, without: Part) -> DataFrame | None:
    """One row: the newest event time of earlier batches, or no frame if there are none."""
    parts, _ = log.live(without)
    if not parts:
        return None
    return spark.read.parquet(*[f"{log.path(p)}/newest" for p in parts]).agg(F.max(column).alias("newest"))


def take_in(stream: DataFrame, root: str, checkpoint: str, event_time: str, delay: str) -> str:
    """Take what has arrived into the tables at ``root``; a ``_corrupt_record`` column, if there is one, tells bad lines."""
    spark, log = stream.sparkSession, journal(stream.sparkSession, root)

    def write(batch: DataFrame, path: str, part: Part) -> str:
        bad = F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)
        before, time = _newest(spark, log, event_time, part), F.col(event_time)
        late = F.lit(False) if before is None else F.coalesce(time < before.select(F.col("newest") - F.expr(f"interval {delay}")).scalar(), F.lit(False))
        # One pass over the source: the batch is written once, under its kind, and read from there.
        kind = F.when(bad, "bad").when(late, "late").otherwise("rows")
        judged = batch.withColumn(_KIND, kind)
        told = observed_write(judged, f"{path}/all", batch.columns)
        kept = spark.read.schema(judged.schema).parquet(f"{path}/all")
        for name in KINDS:
            rows = kept.where(F.col(_KIND) == name).drop(_KIND)
            line = F.col(CORRUPT).alias("line") if CORRUPT in batch.columns else F.lit(None).cast("string").alias("line")
            rows = rows.select(line) if name == "bad" else rows.drop(CORRUPT)
            rows.write.mode("overwrite").parquet(f"{path}/{name}")
        kept.where(F.col(_KIND) == "rows").agg(F.max(event_time).alias(event_time)).write.mode("overwrite").parquet(f"{path}/newest")
        log.drop(f"{path}/all")
        return told

    land_batches(stream, log, write, checkpoint)
    return root


def read_taken(spark: SparkSession, root: str, kind: str = "rows") -> DataFrame:
    """All rows of a kind: ``rows``, ``late``, or ``bad`` (the text of each line)."""
    if kind not in KINDS:
        raise ValueError(f"no rows are kept as {kind}")
    parts, _ = journal(spark, root).live()
    if not parts:
        raise FileNotFoundError(f"nothing has been taken in under {root}")
    return spark.read.parquet(*[f"{journal(spark, root).path(p)}/{kind}" for p in parts])
