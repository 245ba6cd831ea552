"""Writing layer tables. Every write reports its row count from the write itself, without a second scan.

No write but ``append`` touches files that are there: each makes the table's next version, which may list partitions of earlier
ones (see ``sources.versions``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.dedup import newest_first, top_per_key
from tidemill.schemas import LAYOUTS, Layout, conform, layout
from tidemill.sources.tables import read_layer, table_path
from tidemill.sources.files import delete
from tidemill.sources.versions import current, finish, folders, following, latest, listed, parts, version_path


@dataclass(frozen=True)
class RunReport:
    table: str
    rows: int
    path: str


def _laid_out(df: DataFrame, plan: Layout) -> tuple[DataFrame, str | None]:
    """Declared columns, the derived partition column, and rows gathered per partition in evenly sized tasks.

    The rebalance hint lets adaptive execution split a partition value that holds many rows and merge small ones, so a
    write makes neither a file per task and day nor one huge file for a hot category.
    """
    if plan.schema.fields:
        df = conform(df, plan.schema)
    column = plan.partition_column
    if column and plan.by_day:
        df = df.withColumn(column, F.to_date(plan.by))
    if column:
        df = df.hint("rebalance", column)
    if plan.sort:
        df = df.sortWithinPartitions(*([column] if column else []), *plan.sort)
    return df, column


def _write(df: DataFrame, column: str | None, mode: str, done: bool = True) -> DataFrameWriter:
    writer = df.write.mode(mode)
    if column:
        writer = writer.partitionBy(column)
    return writer if done else writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


def _counted(df: DataFrame, name: str, path: str, column: str | None, mode: str, done: bool = True) -> RunReport:
    """Write and count; without ``done`` the version does not count yet."""
    seen = Observation()
    _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), column, mode, done).parquet(path)
    return RunReport(name, seen.get["rows"], path)


def init_layers(spark: SparkSession, root: str, tables: list[str] | None = None) -> list[str]:
    """Create the declared tables that do not exist yet, empty; existing ones are left as they are."""
    made = []
    for table in tables or list(LAYOUTS):
        layer, _, name = table.partition(".")
        if current(spark, table_path(root, layer, name)) is None:
            replace_table(spark.createDataFrame([], layout(table).schema), root, layer, name)
            made.append(table)
    return made


MOST_VERSIONS = 16  # that a version's partitions lie in, before the table is written as a whole


def _next_parts(df: DataFrame, root: str, layer: str, name: str, column: str, gone: set[str] | None, add: bool = False) -> RunReport:
    """Write partitions as the next version, which lists all others where they are.

    ``gone`` names the partition folders that the rows replace (None: those that the rows occur in); ``add`` keeps their old rows.
    """
    spark, table = df.sparkSession, f"{layer}.{name}"
    path = table_path(root, layer, name)
    before, target = latest(spark, path), following(spark, path)
    report = _counted(df, table, target, column, "overwrite", done=False)
    if report.rows == 0 and not gone:
        delete(spark, target)
        return RunReport(table, 0, version_path(path, before))
    written = folders(spark, target)
    held = {} if before is None else parts(spark, path, before)
    replaced = set() if add else set(written) if gone is None else gone
    held = {f: versions for f, versions in held.items() if f not in replaced}
    for f in written:
        held.setdefault(f, []).append(int(target[-6:]))
    finish(spark, target, held)
    if len({v for versions in held.values() for v in versions}) > MOST_VERSIONS:
        compact(spark, root, layer, name)
    return report


def overwrite_partitions(df: DataFrame, root: str, layer: str, name: str) -> RunReport:
    """Replace only the partitions that occur in ``df``; the others stay, and an empty input changes nothing.

    A table without partitions is replaced as a whole, by rows if there are any. ``df`` may read the table it overwrites.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    if current(spark, path) is None:
        return replace_table(df, root, layer, name)
    rows, column = _laid_out(df, layout(f"{layer}.{name}"))
    if column:
        return _next_parts(rows, root, layer, name, column, None)
    report = _counted(rows, f"{layer}.{name}", following(spark, path), None, "overwrite", done=False)
    if report.rows:
        finish(spark, report.path)
        return report
    delete(spark, report.path)
    return RunReport(report.table, 0, current(spark, path))


def _folder_of(spark: SparkSession, column: str, value: object) -> str:
    """The folder that Spark gives a partition value."""
    paths = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return paths.getPartitionPathString(column, None if value is None else str(value))


def merge_rows(df: DataFrame, root: str, layer: str, name: str, key: str = "id", newest_by: str = "updated_at") -> RunReport:
    """Insert new keys and replace the rows of known ones, wherever they lie; an empty input changes nothing.

    Of several rows of a key the newest counts; rows without a key are kept as they are and replace nothing. A key that moves
    to another partition leaves the one it was in: partitions that hold old rows of the input's keys are written again without
    them, partitions that lose all rows go, and all others are not touched. The report counts all rows written.
    """
    spark, path, plan = df.sparkSession, table_path(root, layer, name), layout(f"{layer}.{name}")
    keyed = top_per_key(df.where(F.col(key).isNotNull()), [key], newest_first(df, [newest_by]))
    df = keyed.unionByName(df.where(F.col(key).isNull()))
    if current(spark, path) is None:
        return replace_table(df, root, layer, name)
    old = read_layer(spark, root, layer, name, with_partition=True)
    keys, column = df.select(key), plan.partition_column
    if not column:
        if df.isEmpty():
            return RunReport(f"{layer}.{name}", 0, current(spark, path))
        return replace_table(old.join(keys, key, "left_anti").unionByName(conform(df, plan.schema)), root, layer, name)
    # Only the partitions' values reach the driver, no more than the table has folders.
    own = (F.to_date(plan.by) if plan.by_day else F.col(column)).alias(column)
    moved = [r[0] for r in old.join(keys, key, "left_semi").select(column).distinct().collect()]
    touched = {r[0] for r in df.select(own).distinct().collect()} | set(moved)
    inside = F.col(column).isin([v for v in touched if v is not None]) | (F.col(column).isNull() & F.lit(None in touched))
    rest = old.where(inside).join(keys, key, "left_anti").select(*plan.schema.names)
    rows, column = _laid_out(rest.unionByName(conform(df, plan.schema)), plan)
    return _next_parts(rows, root, layer, name, column, {_folder_of(spark, column, v) for v in touched})


def replace_table(df: DataFrame, root: str, layer: str, name: str) -> RunReport:
    """Replace the whole table by writing its next version; ``df`` may read the version it replaces."""
    target = following(df.sparkSession, table_path(root, layer, name))
    rows, column = _laid_out(df, layout(f"{layer}.{name}"))
    return _counted(rows, f"{layer}.{name}", target, column, "overwrite")


def append(df: DataFrame, root: str, layer: str, name: str) -> RunReport:
    """Add rows: to the current version, or next to it where that one lists partitions of others."""
    spark, folder = df.sparkSession, table_path(root, layer, name)
    number = latest(spark, folder)
    rows, column = _laid_out(df, layout(f"{layer}.{name}"))
    if number is not None and listed(spark, folder, number) is not None:
        return _next_parts(rows, root, layer, name, column, None, add=True)
    return _counted(rows, f"{layer}.{name}", version_path(folder, number or 0), column, "append")


def compact(spark: SparkSession, root: str, layer: str, name: str, target_mb: int = 256) -> RunReport | None:
    """Rewrite a table's many small files as files near ``target_mb``, as its next version; None if it is empty.

    The size of the output tasks is left to adaptive execution, through its advisory partition size.
    """
    try:
        rows = read_layer(spark, root, layer, name)
    except FileNotFoundError:
        return None
    if rows.isEmpty():
        return None
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, f"{target_mb}m")
    try:
        plan = layout(f"{layer}.{name}")
        rows = rows if plan.partition_column else rows.hint("rebalance")
        return replace_table(rows, root, layer, name)
    finally:
        spark.conf.set(key, before)
