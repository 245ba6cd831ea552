"""Event files and event streams of JSON objects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import with_defaults

CORRUPT = "_corrupt_record"
# Spark writes milliseconds unless told otherwise; event times carry microseconds.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_json_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines of a folder under a declared schema, so the files are scanned once, not twice.

    Lines that do not parse, and values that do not fit, become NULL; ``quarantine_json`` keeps such lines apart.
    """
    return spark.read.schema(schema).json(path)


def quarantine_json(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, raw text of the lines that did not parse under the schema).

    The lines are read as text and parsed in a projection: Spark refuses to query the corrupt column alone straight
    from a JSON scan.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.withColumn(
        "event", F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    )
    good = parsed.where(F.col(f"event.{CORRUPT}").isNull()).select(*[f"event.{n}" for n in schema.names])
    bad = parsed.where(F.col(f"event.{CORRUPT}").isNotNull()).select(F.col("value").alias("line"))
    return good, bad


def read_kafka_json(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, start: str = "latest", **extra: str
) -> DataFrame:
    """A topic of JSON objects; needs the Kafka connector on the classpath."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **extra}
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("event")).select("event.*")


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    since: datetime | None = None,
    files_per_batch: int | None = None,
    defaults: dict[str, object] | None = None,
    corrupt: bool = False,
) -> DataFrame:
    """A folder of event files as a stream, from the first file on or only files written at or after ``since``.

    ``defaults`` fills declared fields that producers leave out. With ``corrupt`` JSON lines that do not parse under the schema are
    kept as text in the column ``_corrupt_record``, whose other fields hold what could be read.
    """
    kept = _with_corrupt(schema) if corrupt else schema
    reader = spark.readStream.format(fmt).schema(kept)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    stream = reader.load(path)
    if since is not None:
        stream = stream.where(F.col("_metadata.file_modification_time") >= F.lit(since)).select(*kept.names)
    return with_defaults(stream, kept, **defaults) if defaults else stream
