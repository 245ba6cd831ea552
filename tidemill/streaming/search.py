"""A keyword index that follows a change stream: segments, tombstones and merging.

The index at a folder is a journal of segments. Each micro-batch writes one, of its own rows alone:

``versions``
    (key, seq, length, live): the newest change of each key, if it is newer than what the index has. A delete is a version
    that is not live; it stays, so that an older change arriving late cannot bring the document back.
``terms``
    (term, key, seq, length, tf) of the live versions, sorted by term.
``dead``
    (key, seq, length, live) of the versions of earlier segments that these replace: tombstones. No earlier segment is touched.

A search reads the row groups of its words in all segments and leaves out what is dead. The corpus' size and mean length are the
sums over versions less those over tombstones, kept as one row for each segment (``stats``). Merging writes several segments as
one: dead versions go, and so do their tombstones. Segments are merged level by level, so a version is rewritten about
once for each level, and there are at most ``FAN_IN`` segments a level.

Changes without a key are left out; without a sequence they count as older than any other; of equal sequences the first one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import tokens
from tidemill.operators.changes import newest_change
from tidemill.operators.search import index_terms, search_index
from tidemill.sources.changes import DELETE, OP, SEQ
from tidemill.sources.journal import Journal, Merged, Part, observed_write
from tidemill.streaming.runner import land_batches

PREFIX = "segment-"
FAN_IN = 8
_LOWEST = -(1 << 63)
_VERSION = ("key", "seq", "length", "live")
_STATS = ("n", "length")


def journal(spark: SparkSession, root: str) -> Journal:
    return Journal(spark, root, PREFIX)


class Segments:
    """The live segments of an index, but for the one ``without`` that is being written again."""

    def __init__(self, spark: SparkSession, root: str, without: Part | None = None) -> None:
        self.spark, self.log = spark, journal(spark, root)
        self.parts, self.merged = self.log.live(without)

    def read(self, table: str, of: list[Part | Merged] | None = None) -> DataFrame | None:
        found = [f"{self.log.path(p)}/{table}" for p in ([*self.merged, *self.parts] if of is None else of)]
        # One schema holds for all segments; it is taken from the first one's files.
        return self.spark.read.schema(self.spark.read.parquet(found[0]).schema).parquet(*found) if found else None

    def current(self, versions: DataFrame | None = None) -> DataFrame | None:
        """Versions that nothing has replaced, deletes among them."""
        versions = self.read("versions") if versions is None else versions
        return versions if versions is None else versions.join(self.read("dead").select("key", "seq"), ["key", "seq"], "left_anti")

    def terms(self) -> DataFrame | None:
        found = self.read("terms")
        return found if found is None else found.join(self.read("dead").select("key", "seq"), ["key", "seq"], "left_anti")

    def corpus(self) -> DataFrame:
        """One row (n, mean): documents and their mean length in words."""
        total = self.read("stats").agg(*[F.sum(c).alias(c) for c in _STATS])
        return total.select(F.col("n").cast("double").alias("n"), (F.col("length") / F.col("n")).alias("mean"))


def _stats(added: DataFrame, removed: DataFrame) -> DataFrame:
    rows = added.where("live").select(F.lit(1).alias("n"), "length").union(removed.where("live").select(F.lit(-1), -F.col("length")))
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _STATS])


def _segment(batch: DataFrame, path: str, before: Segments, key: str, text: str, seq: str) -> str:
    """Write the segment of a batch of changes; returns the digest of its newest changes."""
    spark = batch.sparkSession
    rows = batch.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.coalesce(F.col(seq).cast("long"), F.lit(_LOWEST)).alias("seq"), (F.coalesce(F.col(OP), F.lit("")) != DELETE).alias("live"), F.col(text).alias("text")
    )
    newest = newest_change(rows, "key", "seq")
    # The batch is read from here on: the changes once, however many tables are made of them.
    told = observed_write(newest, f"{path}/changes")
    newest = spark.read.schema(newest.schema).parquet(f"{path}/changes")
    known = before.read("versions")
    if known is None:
        fresh, dead = newest, newest.limit(0).select("key", "seq", F.lit(0).alias("length"), "live")
    else:
        # Keys of the batch are few beside the index; only these keys' versions are looked at.
        mine = before.current(known.join(newest.select("key"), "key", "left_semi")).withColumnRenamed("seq", "old")
        mine.write.mode("overwrite").parquet(f"{path}/known")
        mine = spark.read.schema(mine.schema).parquet(f"{path}/known")
        ahead = newest.join(mine.select("key", "old"), "key", "left").where(F.col("old").isNull() | (F.col("seq") > F.col("old")))
        fresh = ahead.select("key", "seq", "live", "text")
        dead = mine.join(fresh.select("key"), "key", "left_semi").select("key", F.col("old").alias("seq"), "length", "live")
    length = F.when(F.col("live"), F.size(tokens(F.coalesce("text", F.lit(""))))).otherwise(0)
    versions = fresh.select("key", "seq", length.alias("length"), "live")
    alive = fresh.where("live").select("key", "seq", F.coalesce("text", F.lit("")).alias("text"))
    # A batch's newest changes are one for each key, so words are counted where the texts lie.
    terms = index_terms(alive, "key", "text", ("seq",), unique=True).select("term", "key", "seq", "length", "tf")
    _store(path, versions, terms, dead)
    for scratch in ("changes", "known"):
        before.log.drop(f"{path}/{scratch}")
    return told


def _store(path: str, versions: DataFrame, terms: DataFrame, dead: DataFrame, stats: DataFrame | None = None) -> None:
    """Write a segment; without ``stats`` they are counted from what was written, not from the texts again."""
    # Gathered and sorted, so that a search skips all but a few row groups and a batch finds its keys.
    terms.hint("rebalance", "term").sortWithinPartitions("term", "key").write.mode("overwrite").parquet(f"{path}/terms")
    versions.select(*_VERSION).sortWithinPartitions("key").write.mode("overwrite").parquet(f"{path}/versions")
    dead.select(*_VERSION).write.mode("overwrite").parquet(f"{path}/dead")
    if stats is None:
        read = versions.sparkSession.read
        stats = _stats(*[read.schema(df.select(*_VERSION).schema).parquet(f"{path}/{t}") for t, df in (("versions", versions), ("dead", dead))])
    stats.write.mode("overwrite").parquet(f"{path}/stats")


def index_stream(changes: DataFrame, root: str, checkpoint: str, key: str, text: str, seq: str = SEQ) -> None:
    """Take the changes that have arrived into the index at ``root``; one segment for each micro-batch."""
    spark = changes.sparkSession

    def write(batch: DataFrame, path: str, part: Part) -> str:
        return _segment(batch, path, Segments(spark, root, without=part), key, text, seq)

    land_batches(changes, journal(spark, root), write, checkpoint)


def _due(segments: Segments, fan_in: int, everything: bool) -> tuple[list[Part], list[Merged]] | None:
    """What to merge next: the oldest segments of the lowest level that has ``fan_in`` of them."""
    if everything:
        return (segments.parts, segments.merged) if len(segments.parts) + len(segments.merged) > 1 else None
    if len(segments.parts) >= fan_in:
        return segments.parts[:fan_in], []
    for level in sorted({m.level for m in segments.merged}):
        same = [m for m in segments.merged if m.level == level]
        if len(same) >= fan_in:
            return [], same[:fan_in]
    return None


def merge_segments(spark: SparkSession, root: str, fan_in: int = FAN_IN, everything: bool = False) -> list[Merged]:
    """Merge segments while a level has ``fan_in`` of them, or all into one; returns the segments made."""
    made = []
    while due := _due(segments := Segments(spark, root), fan_in, everything):
        parts, merged = due
        chosen: list[Part | Merged] = [*merged, *parts]
        dead = segments.read("dead").select("key", "seq")
        versions, terms = (segments.read(t, chosen).join(dead, ["key", "seq"], "left_anti") for t in ("versions", "terms"))
        # Tombstones of versions that lie in other segments are still needed.
        inside = segments.read("versions", chosen).select("key", "seq")
        kept = segments.read("dead", chosen).join(inside, ["key", "seq"], "left_anti")
        stats = segments.read("stats", chosen).agg(*[F.sum(c).alias(c) for c in _STATS])
        columns = ("term", "key", "seq", "length", "tf")
        made.append(segments.log.merge(parts, merged, lambda path: _store(path, versions, terms.select(*columns), kept, stats)))  # noqa: B023
    return made


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete the segments that merged ones stand for."""
    return journal(spark, root).expire()


def search(spark: SparkSession, root: str, query: str, k: int = 10, key: str = "key") -> DataFrame:
    """The k best documents of the index as it is now for any of the query's words, as (key, score)."""
    segments = Segments(spark, root)
    terms = segments.terms()
    if terms is None:
        raise FileNotFoundError(f"no change has been indexed under {root}")
    return search_index(terms, segments.corpus(), query, k, "key").withColumnRenamed("key", key)


def documents(spark: SparkSession, root: str, key: str = "key") -> DataFrame:
    """Keys, sequences and lengths of the documents that a search can find."""
    current = Segments(spark, root).current()
    if current is None:
        raise FileNotFoundError(f"no change has been indexed under {root}")
    return current.where("live").select(F.col("key").alias(key), "seq", "length")

