"""Keeping a keyed table up to date from a change stream.

The table is a folder with a base and deltas, kept by a journal. Each micro-batch writes one delta, reduced to the newest
change per key; it is named after its run and batch, so a replay overwrites itself, a new checkpoint adds to what earlier ones wrote,
and a batch costs no more than its own rows. Readers merge base and deltas; ``fold`` writes them as the next base when the deltas
have grown. A base says which batches it covers, so a delta is never hidden behind a base that was made without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators.changes import apply_changes, live, newest_change
from tidemill.sources.changes import SEQ
from tidemill.sources.journal import Journal, Part, observed_write
from tidemill.streaming.runner import land_batches

PREFIX = "delta-"


def journal(spark: SparkSession, root: str) -> Journal:
    return Journal(spark, root, PREFIX)


def apply_stream(changes: DataFrame, root: str, checkpoint: str, key: str, seq: str = SEQ) -> None:
    """Take the changes that have arrived into the table at ``root``."""

    def write(batch: DataFrame, path: str, part: Part) -> str:
        return observed_write(newest_change(batch, key, seq), path)

    land_batches(changes, journal(changes.sparkSession, root), write, checkpoint)


def _merged(base: DataFrame | None, changes: DataFrame | None, key: str, seq: str) -> DataFrame:
    """A base has one row per key already; few changes are applied to it without shuffling it."""
    if changes is None:
        return base
    return newest_change(changes, key, seq) if base is None else apply_changes(base, changes, key, seq)


def _read(spark: SparkSession, root: str) -> tuple[list[Part], list, DataFrame | None, DataFrame | None]:
    log = journal(spark, root)
    parts, bases = log.live()
    base = spark.read.parquet(*[log.path(b) for b in bases]) if bases else None
    changes = spark.read.parquet(*[log.path(p) for p in parts]) if parts else None
    return parts, bases, base, changes


def read_state(spark: SparkSession, root: str, key: str, seq: str = SEQ, with_deleted: bool = False) -> DataFrame:
    """The table's current rows."""
    _, _, base, changes = _read(spark, root)
    if base is None and changes is None:
        raise FileNotFoundError(f"no change has been applied under {root}")
    state = _merged(base, changes, key, seq)
    return state if with_deleted else live(state)


def fold(spark: SparkSession, root: str, key: str, seq: str = SEQ) -> int:
    """Write base and deltas as one new base; returns the last batch number of the latest run it covers (-1 for none)."""
    parts, bases, base, changes = _read(spark, root)
    log = journal(spark, root)
    if parts:
        bases = [log.merge(parts, bases, _merged(base, changes, key, seq).write.mode("overwrite").parquet)]
    covers = bases[-1].covers if bases else {}
    return covers[max(covers)][-1][1] if covers else -1


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete the deltas and bases that the newest base covers."""
    return journal(spark, root).expire()
