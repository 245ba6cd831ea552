"""Starting streams. Every stream has a checkpoint folder, so it goes on where it stopped."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemill import fixed
from tidemill.sources.journal import Journal, Part


def with_event_time(df: DataFrame, column: str = "event_time", delay: str = fixed.LOGIN_WATERMARK) -> DataFrame:
    """Event time plus watermark: rows later than ``delay`` behind the newest seen are dropped by windows."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append to files, or to a topic with ``fmt="kafka"``; without ``every`` it takes what is there and ends."""
    if fmt == "kafka":
        df = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        writer = df.writeStream.format("kafka").option("topic", path)
    else:
        writer = df.writeStream.format(fmt).option("path", path)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint).options(**options)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_append(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> str:
    """Run a stream over what has arrived, to the end; returns the sink's folder."""
    query = write_stream(df, path, checkpoint, fmt)
    query.awaitTermination()
    return path


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a function over every micro-batch of what has arrived. A replayed batch has the same number as before."""
    query = (
        df.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_batches(
    df: DataFrame, journal: Journal, write: Callable[[DataFrame, str, Part], str], checkpoint: str, mode: str = "append"
) -> None:
    """Write every micro-batch of what has arrived as a part of a table; ``write`` gives the digest of its rows.

    Parts go by the stream's own id, which its checkpoint keeps, so every checkpoint has its own run of batches.
    """
    known, started = [], threading.Event()

    def each(batch: DataFrame, number: int) -> None:
        started.wait()
        journal.land(known[0], number, lambda path, part: write(batch, path, part))

    query = (
        df.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    known.append(query.id)
    started.set()
    query.awaitTermination()


@dataclass(frozen=True)
class Job:
    name: str
    build: Callable[[], DataFrame]
    path: str
    checkpoint: str
    fmt: str = "json"


def start_jobs(jobs: list[Job], every: str | None = None) -> list[StreamingQuery]:
    """Start independent jobs side by side, each with its own read of the source and its own progress."""
    return [write_stream(j.build(), j.path, j.checkpoint, j.fmt, every, j.name) for j in jobs]


def await_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def stream_dedup(df: DataFrame, keys: list[str], column: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """Drop repeats of an event that arrive within ``delay`` of the first one; state older than that is forgotten."""
    return with_event_time(df, column, delay).dropDuplicatesWithinWatermark(keys)


def active(spark: SparkSession) -> list[str]:
    return [q.name or str(q.id) for q in spark.streams.active]
