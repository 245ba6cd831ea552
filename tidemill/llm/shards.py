"""K-d tree sharding by bytes, with DataFrame functions only.

Every row is a point over metadata dimensions, each a 63-bit integer key whose high bits are the value scaled to its range and whose low
bits break ties: first by the text's checksum, so equal texts lie side by side, then by a hash of the row. A node that must hold k
shards is split along the dimension in which it is widest, at the point below which floor(k / 2) / k of its bytes lie, until every leaf holds
one shard's bytes. All nodes of a level are split together: their extents come from one aggregation, and their weighted medians from
histograms that are narrowed around the crossing, one aggregation a round, until the crossing bin holds a single row or at most
``TOLERANCE`` of a shard. Rows are never gathered or sorted for this; only the histograms' crossing bins, at most one for each
node, come to the driver.

Slots count a shard's rows without a gap. Rows get their place in one of many small parts of a shard, and parts' sizes are
summed up in front of each part, so a shard is never one task.

Defined results: a null text has 0 bytes (size 16) and a null checksum; null metadata sort first; fewer rows than shards leave shards empty; an
empty table gives no rows. A group of equal texts larger than a shard is cut, as sizes are the law here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import settle, written

OVERHEAD = 16
BINS = 4096
TOLERANCE = 0.0005
VALUE_BITS, TEXT_BITS, ROW_BITS = 25, 19, 19
PART_ROWS = 20_000


def _key(value: Column, low: float, high: float) -> Column:
    """Value scaled to [low, high] in the high bits, then the tie breakers."""
    top = (1 << VALUE_BITS) - 1
    scaled = F.least(F.greatest((value - low) / (high - low) * top, F.lit(0.0)), F.lit(float(top))) if high > low else F.lit(0.0)
    scaled = F.coalesce(scaled, F.lit(0.0)).cast("long")
    return F.shiftleft(scaled, TEXT_BITS + ROW_BITS).bitwiseOR(F.shiftleft(F.col("_text_tie"), ROW_BITS)).bitwiseOR(F.col("_row_tie"))


def _pick(values: list, at: Column, kind: str = "bigint") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), (at + 1).cast("int"))


def _keyed(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Add the keys ``_k0``, ``_k1``, ... of the dimensions, scaled to each one's extent in the table."""
    ends = rows.agg(*[f(F.col(d).cast("double")).alias(f"{n}{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    keys = {f"_k{i}": _key(F.col(d).cast("double"), ends[f"lo{i}"] or 0.0, ends[f"hi{i}"] or 0.0) for i, d in enumerate(dims)}
    return rows.withColumns(keys)


def _widest(points: DataFrame, node: Column, n_dims: int) -> dict[int, tuple]:
    """node -> (bytes, widest dimension, its smallest and largest key)."""
    ends = [f(F.col(f"_k{i}")).alias(f"{n}{i}") for i in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))]
    out = {}
    for r in points.groupBy(node.alias("node")).agg(F.sum("size").alias("bytes"), *ends).collect():
        dim = max(range(n_dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        out[r.node] = (r.bytes, dim, r[f"lo{dim}"], r[f"hi{dim}"])
    return out


def _medians(points: DataFrame, node: Column, n_nodes: int, extents: dict[int, tuple], share: dict[int, float], slack: float) -> dict[int, int]:
    """node -> the key below which its left side lies, within ``slack`` bytes or exact."""
    low = {n: e[2] for n, e in extents.items()}
    width = {n: max(1, -(-(e[3] - e[2] + 1) // BINS)) for n, e in extents.items()}
    goal = {n: e[0] * share[n] for n, e in extents.items()}  # bytes still to be put left of the interval
    found: dict[int, int] = {}
    while len(found) < len(extents):
        open_ = [n for n in extents if n not in found]
        on = _pick([int(n in extents and n not in found) for n in range(n_nodes)], node) == 1
        keys = F.array(*[F.col(c) for c in points.columns if c.startswith("_k")])
        key = F.element_at(keys, _pick([extents[n][1] + 1 if n in extents else 1 for n in range(n_nodes)], node, "int"))
        base = _pick([low.get(n, 0) for n in range(n_nodes)], node)
        wide = _pick([width.get(n, 1) for n in range(n_nodes)], node)
        binned = (
            points.where(on)
            .select(node.alias("node"), (key - base).alias("far"), wide.alias("wide"), "size")
            .where((F.col("far") >= 0) & (F.col("far") < F.col("wide") * BINS))
            .selectExpr("node", "far div wide as bin", "size")
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        )
        before = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin")) - F.col("bytes")
        aims = _pick([float(goal.get(n, 0.0)) for n in range(n_nodes)], F.col("node"), "double")
        crossing = binned.withColumn("before", before).where((F.col("before") <= aims) & (F.col("before") + F.col("bytes") > aims)).collect()
        seen = {r.node: r for r in crossing}
        for n in open_:
            r = seen.get(n)
            if r is None:  # nothing lies beyond the goal
                found[n] = low[n] + width[n] * BINS
                continue
            left = low[n] + r.bin * width[n]
            if width[n] == 1 or r.rows == 1 or r.bytes <= slack:
                nearer = goal[n] - r.before <= r.before + r.bytes - goal[n]
                found[n] = left if nearer else left + width[n]
            else:
                low[n], goal[n], width[n] = left, goal[n] - r.before, -(-width[n] // BINS)
    return found


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
    metadata: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, for ``shards`` shards or leaves of ``target_bytes``.

    The dimensions are the id, the size and a checksum of each ``metadata`` column. A table of a few numbers a row is written first
    and with each level's nodes again; all passes run over it. Trees are meant for up to some ten thousand leaves: one split of each node comes to the driver.
    """
    settle(docs.sparkSession)
    text = F.col(text_col).cast("binary")
    marks = {f"_m{i}": F.crc32(F.col(c).cast("string").cast("binary")) for i, c in enumerate(metadata)}
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        *[c.alias(n) for n, c in marks.items()],
    )
    slim = written(slim, "shards")  # the row numbers must not change from here on
    ties = {
        "_text_tie": F.pmod(F.xxhash64(F.coalesce("text_crc32", F.lit(-1))), F.lit(1 << TEXT_BITS)),
        "_row_tie": F.pmod(F.xxhash64("row"), F.lit(1 << ROW_BITS)),
    }
    points = _keyed(slim.withColumns(ties), ["doc_id", "size", *marks]).withColumn("_node", F.lit(0)).drop(*ties, *marks)
    n_dims = 2 + len(marks)
    total = slim.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, -(-total // (target_bytes or 1)))
    slack = TOLERANCE * total / shards
    node, holds = F.col("_node"), [(0, shards)]  # of each node: its first shard and how many it holds
    while any(k > 1 for _, k in holds) and total:
        points = written(points, "shards")  # a level's jobs read its nodes as a column, however deep the tree
        wide = {n: e for n, e in _widest(points, node, n_dims).items() if holds[n][1] > 1}
        cut = _medians(points, node, len(holds), wide, {n: (holds[n][1] // 2) / holds[n][1] for n in wide}, slack)
        nexts, left_of, right_of = [], [], []
        for n, (first, k) in enumerate(holds):
            left_of.append(len(nexts))
            if k > 1:
                nexts += [(first, k // 2), (first + k // 2, k - k // 2)]
            else:
                nexts.append((first, k))
            right_of.append(len(nexts) - 1)
        keys = F.array(*[F.col(f"_k{i}") for i in range(n_dims)])
        key = F.element_at(keys, _pick([wide[n][1] + 1 if n in wide else 1 for n in range(len(holds))], node, "int"))
        edge = _pick([min(cut.get(n, 1 << 62), (1 << 63) - 1) for n in range(len(holds))], node)
        side = F.when(key < edge, _pick(left_of, node)).otherwise(_pick(right_of, node)).cast("int")
        points, holds = points.withColumn("_node", side), nexts
    leaves = points.select("doc_id", "size", "text_crc32", "row", _pick([first for first, _ in holds], node).cast("int").alias("shard"))
    return _with_slots(written(leaves, "shards"))


def _with_slots(leaves: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0: in small parts of it, after all parts before."""
    parts = max(1, -(-leaves.count() // PART_ROWS))
    dealt = leaves.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part")
    starts = sizes.select("shard", "part", (F.sum("n").over(ahead) - F.col("n")).alias("ahead"))
    placed = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1)
    return placed.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("ahead") + F.col("nth")).cast("long").alias("slot")
    )
