"""Change logs: rows with an operation, a key, a sequence and the row image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OP, SEQ = "op", "seq"
DELETE = "d"


def envelope_schema(image: T.StructType) -> T.StructType:
    """The JSON envelope: operation, sequence, time, and the row before and after. Decimals travel as text."""
    text = T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in image]
    )
    return T.StructType(
        [
            T.StructField(OP, T.StringType()),
            T.StructField(SEQ, T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("before", text),
            T.StructField("after", text),
        ]
    )


def unwrap(df: DataFrame, image: T.StructType, key: str, value: str = "value") -> DataFrame:
    """Flatten envelopes to ``op, seq, ts`` and the new row image; a delete keeps its key, taken from the old image."""
    parsed = df.select(F.from_json(F.col(value).cast("string"), envelope_schema(image)).alias("e"))

    def field(f: T.StructField) -> Column:
        new = F.col(f"e.after.{f.name}")
        source = F.coalesce(new, F.col(f"e.before.{f.name}")) if f.name == key else new
        return source.cast(f.dataType).alias(f.name)

    return parsed.select("e.op", "e.seq", "e.ts", *[field(f) for f in image])


def read_changes(
    spark: SparkSession, path: str, image: T.StructType, key: str, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of envelope lines as a stream: what lies there is the snapshot, what arrives later the changes."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return unwrap(reader.load(path), image, key)
