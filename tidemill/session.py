"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Adaptive execution splits the hot keys of a join. Forcing it lets the split happen also where a later step would have
# used the join's partitioning; that step then shuffles once more instead of one task taking a third of all rows.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Texts go to Python in batches of few rows and few bytes, so that very long texts do not fill a worker's memory.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def small_batches(spark: SparkSession) -> SparkSession:
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Set what the operators count on in a session that was made elsewhere."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting, UTC and Arrow on; ``conf`` adds to it."""
    settings = {
        **SCALE_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        STATE_STORE_KEY: ROCKSDB_STATE_STORE,
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Without that setting it is a folder in the warehouse, which executors share too.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one, never reused between runs."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if the cluster set none (iterative jobs cut lineage there)."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streams: UTC, so that event times survive the TIMESTAMP round trip, and on-disk state.

    Stateful steps keep the number of partitions of their first run: the session's, unless ``state_partitions`` names another.
    """
    sibling = tune(spark.newSession())
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set(STATE_STORE_KEY, ROCKSDB_STATE_STORE)
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sibling
