"""Applying change logs: latest state, incremental apply, past states, changed columns.

Changes carry ``op`` (``d`` deletes), a key and a sequence. Deletes stay in the state as tombstones, so that an older
change arriving late cannot bring a row back; ``live`` hides them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import as_ntz
from tidemill.operators.dedup import newest_first, top_per_key
from tidemill.sources.changes import DELETE, OP, SEQ


def newest_change(changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """The change with the highest sequence per key, deletes included. Reduced inside the map tasks first."""
    return top_per_key(changes, [key], newest_first(changes, [seq]))


def live(state: DataFrame) -> DataFrame:
    """The rows of a state that are not deleted."""
    return state.where(F.col(OP) != DELETE)


def latest_state(changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """The current row of every key that is not deleted."""
    return live(newest_change(changes, key, seq))


def apply_changes(state: DataFrame, changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """The state, one row per key, after a batch of changes in any order and with repeats.

    A change replaces the state's row unless that has a higher sequence: on equal sequences the change wins, a missing
    sequence is below all others, and rows without a key share one. The batch is reduced to a row per key first; only keys
    and sequences of it meet the state, so Spark filters the state where it lies as long as those fit its broadcast
    threshold, and shuffles both beyond.
    """
    batch = newest_change(changes, key, seq).select(*state.columns)
    marks = batch.select(F.col(key).alias("__key"), F.col(seq).alias("__seq"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    replaced = F.col(seq).isNull() | F.coalesce(F.col("__seq") >= F.col(seq), F.lit(False))
    kept = state.join(marks, same & replaced, "left_anti")
    # Keys of the state that are ahead of the batch: no more than the batch has.
    ahead = state.join(marks, same & ~replaced, "left_semi").select(F.col(key).alias("__key"))
    return kept.unionByName(batch.join(ahead, same, "left_anti"))


def as_of(history: DataFrame, key: str, at: datetime, ts: str = "ts", seq: str = SEQ) -> DataFrame:
    """The table as it was at a past time: the latest state over the changes up to then."""
    return latest_state(history.where(F.col(ts) <= as_ntz(at)), key, seq)


def changed_columns(changes: DataFrame, columns: list[str], before: str = "before", after: str = "after") -> DataFrame:
    """Names of the columns an update changed, by comparing the full row images; NULL equals NULL."""
    names = [
        F.when(~F.col(f"{before}.{c}").eqNullSafe(F.col(f"{after}.{c}")), F.lit(c)) for c in columns
    ]
    return changes.withColumn("changed", F.array_compact(F.array(*names)))
