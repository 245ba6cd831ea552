"""Lookups as of now: every micro-batch meets the dimension as it is when the batch is taken.

A stream that joins a table sees the table as it was when the stream began. Here the dimension is asked for again for each batch,
so a profile that changes is seen from the next batch on, and rows that were written before keep what was true then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.sources.journal import Journal, Part, observed_write
from tidemill.streaming.runner import land_batches

PREFIX = "part-"


def journal(spark: SparkSession, root: str) -> Journal:
    return Journal(spark, root, PREFIX)


def look_up(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows with the dimension's columns, NULL where the key is unknown.

    The dimension is cut down to the rows' keys first: where those are few it is filtered as it is scanned, not shuffled, and
    what is left of it is small beside the rows, so a key with most of them is no skew.
    """
    found = dimension.join(rows.select(key).distinct(), key, "left_semi")
    return rows.join(found, key, "left")


def enrich_stream(
    stream: DataFrame,
    dimension: Callable[[], DataFrame],
    key: str,
    root: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> str:
    """Take what has arrived into the table at ``root``, each batch with the dimension of its time.

    ``dimension`` is called once for each batch. A replayed batch replaces what it wrote; a batch that another checkpoint has
    delivered before adds nothing, whatever the dimension says now.
    """

    def write(batch: DataFrame, path: str, part: Part) -> str:
        return observed_write(shape(look_up(batch, dimension(), key)), path, batch.columns)

    land_batches(stream, journal(stream.sparkSession, root), write, checkpoint)
    return root


def read_enriched(spark: SparkSession, root: str) -> DataFrame:
    log = journal(spark, root)
    parts, merged = log.live()
    if not parts and not merged:
        raise FileNotFoundError(f"no batch has been enriched under {root}")
    return spark.read.parquet(*[log.path(p) for p in [*merged, *parts]])
