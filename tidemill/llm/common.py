"""What the corpus operators share: session settings, the held-out rule and the bounded sample of labelled rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import run_dir, small_batches, tune
from tidemill.sources.files import delete

FOLDS = 5
BUCKETS = 256


def settle(spark: SparkSession) -> SparkSession:
    """Set what these operators count on in a session that was made elsewhere."""
    return small_batches(tune(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(rows: list[tuple], names: list[str], numbers: set[str]) -> pd.DataFrame:
    """Rows as a frame whose ``numbers`` are exact 64-bit integers even where some are missing."""
    values = zip(*rows, strict=True) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.array(list(v), dtype="Int64") if n in numbers else pd.Series(list(v), dtype=object) for n, v in zip(names, values, strict=True)})


def held_out(doc_id: Column) -> Column:
    """One fifth of the ids, never learned from; a row without an id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it again: computed once, and safe when executors are lost."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``stored`` in a folder of its own under the shared one."""
    return stored(df, run_dir(df.sparkSession, purpose))


class Scratch:
    """Written frames of one computation, in one folder under the shared one that goes when the computation is done."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root, self.count = spark, run_dir(spark, purpose), 0

    def written(self, df: DataFrame) -> DataFrame:
        self.count += 1
        return stored(df, f"{self.root}/{self.count}")

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files of frames that are not read any more, or of all."""
        for path in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()} if frames else {self.root}:
            delete(self.spark, path)


class Once:
    """``make(*args)`` for tasks, to be broadcast: made at its first call in each Python worker and dropped there with the broadcast.

    Spark drops a broadcast from a worker as soon as a task comes that does not use it, so later stages have the memory.
    """

    def __init__(self, make: Callable, *args) -> None:
        self.make, self.args = make, args

    def __getstate__(self) -> dict:
        return {"make": self.make, "args": self.args}

    def __call__(self):
        if not hasattr(self, "made"):
            self.made = self.make(*self.args)
        return self.made


def give_back() -> None:
    """Return what this process has freed to the system: Arrow's pool and the C library keep it otherwise, in idle workers too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function for ``mapInPandas`` whose worker gives freed memory back after each frame and when its task ends."""

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            for part in run(parts):
                yield part
                del part
                give_back()
        finally:
            give_back()

    return each


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the ids that may be learned from: neither held out nor without a label.

    An id with several labels takes their mean, rounded.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    return own.groupBy("doc_id").agg(F.round(F.avg(label)).cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> DataFrame:
    """At most ``per_class`` labelled texts of each class of ``label`` as (doc_id, text, label), chosen by a hash of the id.

    Ids are those of ``learnable`` that have a text of at most ``max_chars``; where there are ``per_class`` of a class, so many are
    taken. Of an id's several texts the smallest counts. Ids are ranked within buckets of their hash first and then among the buckets'
    best, so no task sorts a class as a whole; at most ``per_class`` ids a class are broadcast to read their texts.
    """
    usable = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    hashed = F.xxhash64("doc_id")
    ids = learnable(labels, label).join(usable.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = ids.withColumns({"_hash": hashed, "_bucket": F.pmod(hashed, F.lit(BUCKETS))})
    for keys in (["label", "_bucket"], ["label"]):
        order = Window.partitionBy(*keys).orderBy("_hash", "doc_id")
        ids = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_class).drop("_rank")
    chosen = F.broadcast(ids.select("doc_id", "label"))
    return usable.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
