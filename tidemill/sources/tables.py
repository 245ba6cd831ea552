"""Reading layer tables, and the small scans services make over them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import layout
from tidemill.sources.versions import places


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_layer(spark: SparkSession, root: str, layer: str, name: str, with_partition: bool = False) -> DataFrame:
    """The table's finished version with its declared columns; ``with_partition`` keeps the derived day column.

    A filter on the day column then prunes folders (see ``functions.clock.last``).
    """
    found = places(spark, table_path(root, layer, name))
    if found is None:
        raise FileNotFoundError(f"no finished version of {layer}.{name} under {root}")
    plan = layout(f"{layer}.{name}")
    if not plan.schema.fields:
        return spark.read.parquet(found[0][0])
    names, folder = plan.schema.names, plan.partition_column
    stored = plan.schema
    if folder and folder not in names:
        stored = T.StructType([*stored.fields, T.StructField(folder, T.DateType())])
    # The declared schema spares reading file footers, and an empty table has none to read.
    reader = spark.read.schema(stored)
    frames = [reader.option("basePath", v).parquet(*[f"{v}/{f}" for f in held]) if held else reader.parquet(v) for v, held in found]
    df = reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], stored)
    return df.select(*names, folder) if with_partition and folder and folder not in names else df.select(*names)


def read_dimension(spark: SparkSession, root: str, layer: str, name: str, columns: list[str]) -> DataFrame:
    """A dimension narrowed to the columns a lookup needs. Spark broadcasts it only if its files are small enough."""
    return read_layer(spark, root, layer, name).select(*columns)


def register_views(spark: SparkSession, root: str, tables: list[str]) -> list[str]:
    """Make layer tables known to ``spark.sql``: ``silver.users`` becomes the view ``silver_users``.

    Day columns are kept, so that a filter on them prunes folders.
    """
    names = []
    for table in tables:
        layer, _, name = table.partition(".")
        read_layer(spark, root, layer, name, with_partition=True).createOrReplaceTempView(f"{layer}_{name}")
        names.append(f"{layer}_{name}")
    return names


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the finished ones yet."""
    return df.join(done.select(key), key, "left_anti")


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """All rows of one key; the comparison is pushed into Parquet or the database."""
    return df.where(F.col(key) == F.lit(value))


def is_ready(table: Callable[[], DataFrame]) -> bool:
    """Whether the table can be read and has a row; failing to read it means not ready."""
    try:
        return not table().isEmpty()
    except (PySparkException, FileNotFoundError):
        return False
