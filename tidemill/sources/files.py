"""The few things done to files directly: listing a folder, small text files, deleting. Any store that Spark reaches will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, path = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, found = _at(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    fs, found = _at(spark, path)
    out = fs.create(found, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, found = _at(spark, path)
    fs.delete(found, True)
