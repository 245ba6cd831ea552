"""Version folders of a table.

A table is a folder of numbered Parquet folders; readers take the newest one whose write has finished. A replace, a merge or
a compaction writes the next number and so never touches files that a running query reads.

A version holds the whole table, or only the partitions that a write changed: then a list in it names, for each partition of
the table, the versions whose folders hold its rows, and the partitions that have no rows any more are not on it.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidemill.sources.files import delete, names, read_text, write_text

PREFIX = "v"
PARTS = "_parts.json"
DONE = "_SUCCESS"


def finished(spark: SparkSession, path: str) -> bool:
    return DONE in names(spark, path)


def numbered(spark: SparkSession, path: str, prefix: str = PREFIX) -> list[int]:
    """Numbers of the finished ``<prefix>NNN`` folders under a path, ascending."""
    found = [n for n in names(spark, path) if n.startswith(prefix) and n[len(prefix):].isdigit()]
    return sorted(int(n[len(prefix):]) for n in found if finished(spark, f"{path}/{n}"))


def version_path(path: str, number: int) -> str:
    return f"{path}/{PREFIX}{number:06d}"


def latest(spark: SparkSession, path: str) -> int | None:
    """The newest finished version's number; versions before it need not be looked at."""
    found = sorted((int(n[len(PREFIX):]) for n in names(spark, path) if n.startswith(PREFIX) and n[len(PREFIX):].isdigit()), reverse=True)
    return next((n for n in found if finished(spark, version_path(path, n))), None)


def current(spark: SparkSession, path: str) -> str | None:
    number = latest(spark, path)
    return None if number is None else version_path(path, number)


def following(spark: SparkSession, path: str) -> str:
    number = latest(spark, path)
    return version_path(path, 0 if number is None else number + 1)


def folders(spark: SparkSession, version: str) -> list[str]:
    """Partition folders that lie in a version."""
    return sorted(n for n in names(spark, version) if "=" in n and not n.startswith(("_", ".")))


def listed(spark: SparkSession, path: str, number: int) -> dict[str, list[int]] | None:
    """Partition folder -> versions that hold its rows; None if the version holds the whole table."""
    version = version_path(path, number)
    return json.loads(read_text(spark, f"{version}/{PARTS}")) if PARTS in names(spark, version) else None


def parts(spark: SparkSession, path: str, number: int) -> dict[str, list[int]]:
    """The same for any version of a partitioned table."""
    known = listed(spark, path, number)
    return {f: [number] for f in folders(spark, version_path(path, number))} if known is None else known


def finish(spark: SparkSession, version: str, held: dict[str, list[int]] | None = None) -> None:
    """Make a version count, with the list of its partitions if it does not hold the whole table."""
    if held is not None:
        write_text(spark, f"{version}/{PARTS}", json.dumps(held))
    write_text(spark, f"{version}/{DONE}")


def places(spark: SparkSession, path: str) -> list[tuple[str, list[str]]] | None:
    """(version folder, partition folders in it; none for all of it) of the newest version. None without a version."""
    number = latest(spark, path)
    if number is None:
        return None
    known = listed(spark, path, number)
    if known is None:
        return [(version_path(path, number), [])]
    by: dict[int, list[str]] = {}
    for folder, versions in sorted(known.items()):
        for v in versions:
            by.setdefault(v, []).append(folder)
    return [(version_path(path, v), by[v]) for v in sorted(by)]


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete finished versions before the newest ``keep``; queries still reading one of those would fail.

    Partitions that a kept version lists stay where they are, and the version's other partitions go.
    """
    if keep < 1:
        raise ValueError("the current version cannot be dropped")
    numbers, gone = numbered(spark, path), []
    needed = {(v, f) for n in numbers[-keep:] for f, versions in (listed(spark, path, n) or {}).items() for v in versions}
    for number in numbers[:-keep]:
        version = version_path(path, number)
        if any(v == number for v, _ in needed):
            delete(spark, f"{version}/{DONE}")
            for f in folders(spark, version):
                if (number, f) not in needed:
                    delete(spark, f"{version}/{f}")
        else:
            delete(spark, version)
        gone.append(version)
    return gone
