"""A stored two-level cell index over vectors: approximate search by nearest cells, and exact search by cell bounds.

Directions are clustered into cells of about ``CELL_ROWS`` vectors, so the number of cells grows with the corpus, and cells into about
as many groups as a group has cells. Both are learned from a bounded sample for each centre; all vectors are then put into the
nearest cell of their nearest group. A group and a cell know the largest angle between their centre and a vector of theirs.

An approximate search meets the vectors of each query's nearest cells. An exact one goes on from there: by the triangle inequality
of angles a cell holds nothing nearer than its centre's angle less its radius, so only cells, and before them only groups, whose
bound does not exceed the angle of the k-th neighbour so far are met. Where vectors form clusters that is few of them; where they do
not it is all, and the result is still exact. Met vectors are compared themselves: groups are taken together as bundles of about as many
vectors as a task holds, and a query goes to a bundle once, with a bit for each of its cells there. So what is stored of a query's cells is
a bit for each at most, and what is shuffled grows with queries times bundles and not with queries times groups or cells.

Only the groups' centres and places are broadcast, about the square root of the number of cells; cells are joined by their group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.operators.dedup import top_per_key
from tidemill.operators.similarity import CORPUS_BLOCK, DISTANCE, QUERY, _ranked, _result_schema
from tidemill.session import run_dir

CELL_ROWS = 200
SAMPLE = 64  # vectors for each centre that centres are learned from
PROBE_GROUPS, PROBES = 12, 24
ITERATIONS = 8
SLACK = 1e-6  # of angles, for rounding
MEET_QUERIES = 20_000  # queries that choose their cells in one task, about
TILE, TILE_LEAST = 50_000, 2_000  # queries, and vectors, that meet in one task at most; fewer than the second are not cut
TILES = 8  # blocks that queries, and vectors, are cut into, at least
SLICE_CELLS = 20_000  # cells that a task choosing cells holds, about
PAIR_BLOCKS = 16  # blocks that queries are dealt to for choosing cells, at least
SCORES = 1 << 18  # angles or distances that a task holds at a time
ACROSS = 1024  # vectors that are compared at a time
DENSE_ROWS, SPARSE_ROWS = 256, 4096  # queries compared at a time with all vectors of a block, or with those of their cells
HELD = 1 << 18  # pairs kept at a time until the k best of each query are taken
FOUND = 1 << 21  # rows that a task gives out at most, if a query has no more
UNPACK = 1000  # pairs of a query and a bundle that are made cells at a time
NEAR = 1e-11  # of scores, more than the rounding of a distance
_GROUP_BITS = 24


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_direction(rows: DataFrame, vector: str) -> DataFrame:
    """Adds ``u``, the vector at length 1; vectors without a direction go."""

    @F.pandas_udf("array<double>")
    def unit(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            x = np.array([np.nan] if v is None else v, np.float64)
            length = math.sqrt(float((x * x).sum())) if len(x) else 0.0
            out.append(x / length if 0 < length < math.inf else None)
        return pd.Series(out)

    return rows.withColumn("u", unit(F.col(vector))).where(F.col("u").isNotNull())


def _angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1.0, 1.0))


def _nearest_group(centres: np.ndarray):
    @F.pandas_udf("grp int, angle double")
    def run(vectors: pd.Series) -> pd.DataFrame:
        angles = _angles(np.stack(vectors), centres)
        at = angles.argmin(axis=1)
        return pd.DataFrame({"grp": at.astype(np.int32), "angle": angles[np.arange(len(at)), at]})

    return run


def _lloyd(x: np.ndarray, k: int) -> np.ndarray:
    """Centres of directions: each starts at the vector farthest from those before it."""
    first = [0]
    far = _angles(x, x[:1])[:, 0]
    for _ in range(min(k, len(x)) - 1):
        first.append(int(far.argmax()))
        far = np.minimum(far, _angles(x, x[first[-1] :][:1])[:, 0])
    centres = x[first]
    for _ in range(ITERATIONS):
        at = _angles(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def build(corpus: DataFrame, root: str, key: str = "vec_id", vector: str = "embedding", cell_rows: int = CELL_ROWS, seed: int = 42) -> None:
    """Store the index of a corpus under ``root``: vectors by cell, cells, and groups."""
    spark, scratch = corpus.sparkSession, run_dir(corpus.sparkSession, "cells")
    rows = _stored(_with_direction(corpus.select(F.col(key).alias("key"), F.col(vector).alias("v")), "v"), f"{scratch}/rows")
    count = rows.count()
    cells = max(1, math.ceil(count / cell_rows))
    groups = math.ceil(math.sqrt(cells))
    within = math.ceil(cells / groups)
    sample = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE * groups).select(array_to_vector("u").alias("u"))
    centres = np.zeros((0, 0))
    if count:
        model = KMeans(k=groups, seed=seed, maxIter=ITERATIONS, featuresCol="u").fit(sample)
        centres = np.asarray(model.clusterCenters())
        centres = centres / np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-300)
    grouped = _stored(rows.withColumn("g", _nearest_group(centres)("u")).select("key", "v", "u", "g.grp", "g.angle"), f"{scratch}/grouped")
    sizes = _stored(grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")), f"{scratch}/sizes")

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        found = _lloyd(np.stack(part["u"]), within)
        return pd.DataFrame({"grp": part["grp"].iloc[0], "own": np.arange(len(found), dtype=np.int32), "centre": list(found)})

    few = top_per_key(grouped.select("grp", "key", "u"), ["grp"], [F.xxhash64("key"), F.col("key")], SAMPLE * within)
    own = _stored(few.groupBy("grp").applyInPandas(learn, "grp int, own int, centre array<double>"), f"{scratch}/centres")

    # A group's vectors are dealt over blocks; its centres, about as many as there are groups, go to each block.
    def blocks() -> DataFrame:
        read = spark.read.schema(sizes.schema).parquet(f"{scratch}/sizes")
        return read.select("grp", F.ceil(F.col("n") / CORPUS_BLOCK).cast("int").alias("blocks"))

    dealt = grouped.join(blocks(), "grp").select("key", "v", "u", "grp", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"))
    shown = own.join(blocks(), "grp").select("grp", "own", "centre", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def assign(part: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({"key": [], "v": [], "grp": [], "own": [], "angle": []})
        angles = _angles(np.stack(part["u"]), np.stack(centres["centre"]))
        at = angles.argmin(axis=1)
        return pd.DataFrame(
            {"key": part["key"], "v": part["v"], "grp": part["grp"], "own": centres["own"].to_numpy()[at], "angle": angles[np.arange(len(at)), at]}
        )

    fields = rows.schema
    schema = f"key {fields['key'].dataType.simpleString()}, v {fields['v'].dataType.simpleString()}, grp int, own int, angle double"
    put = dealt.groupBy("grp", "block").cogroup(shown.groupBy("grp", "block")).applyInPandas(assign, schema)
    cell = F.shiftleft(F.col("grp").cast("long"), _GROUP_BITS) + F.col("own")
    put = put.withColumn("cell", cell).hint("rebalance", "cell").sortWithinPartitions("cell", "key")
    put = _stored(put, f"{root}/vectors")
    full = put.groupBy("grp", "own", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    full.join(own, ["grp", "own"]).write.parquet(f"{root}/cells")
    listed = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "grp int, centre array<double>")
    listed.join(sizes, "grp").write.parquet(f"{root}/groups")


class Cells:
    """A stored index."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.vectors, self.cells = (spark.read.parquet(f"{root}/{name}") for name in ("vectors", "cells"))
        groups = spark.read.parquet(f"{root}/groups").orderBy("grp").collect()
        self.groups = np.array([r.grp for r in groups], np.int32)
        self.centres = np.array([r.centre for r in groups], np.float64)
        self.radius = np.array([r.radius for r in groups], np.float64)


def _to_groups(index: Cells, probes: int | None):
    """The groups a query has to look into: the ``probes`` nearest ones, or all that may hold something within its reach."""
    names, centres, radius = index.groups, index.centres, index.radius

    @F.pandas_udf("array<int>")
    def run(vectors: pd.Series, reach: pd.Series) -> pd.Series:
        angles = _angles(np.stack(vectors), centres)
        if probes is not None:
            return pd.Series(list(names[np.argsort(angles, axis=1, kind="stable")[:, :probes]]))
        near = angles - radius <= reach.to_numpy()[:, None] + SLACK
        return pd.Series([names[row] for row in near])

    return run


def _ragged(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(row, element) of a column of lists."""
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)


def _found_in(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` stand in the sorted ``names``, and which of them do."""
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


def _cells_of(probes: int | None):
    """The cells of a slice that a block of queries has to look into: the ``probes`` nearest of each query's groups, as (query_id, ats,
    angles), or all that may hold something within reach and were not met before, as (query_id, bundle, cells).
    """

    def run(asked: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        names = (QUERY, "bundle", "cells") if probes is None else (QUERY, "ats", "angles")
        found = [pd.DataFrame({c: pd.Series([], dtype=object) for c in names})]
        if asked.empty or cells.empty:
            return found[0]
        cells = cells.sort_values("at")
        at, bit, radius, centres = cells["at"].to_numpy(), cells["bit"].to_numpy(), cells["radius"].to_numpy(), np.stack(cells["centre"])
        groups, of_group = np.unique(cells["grp"], return_inverse=True)
        bundles, begins = np.unique(cells["bundle"], return_index=True)
        width = max(1, SCORES // len(at))
        for begin in range(0, len(asked), width):
            part = asked.iloc[begin : begin + width]
            ids, angles = part[QUERY].to_numpy(), _angles(np.stack(part["u"]), centres)
            rows, wanted = _ragged(part["groups"])
            where, here = _found_in(groups, wanted)
            inside = np.zeros((len(part), len(groups)), bool)
            inside[rows[here], where[here]] = True
            inside = inside[:, of_group]
            if probes is None:
                inside &= angles - radius <= part["reach"].to_numpy()[:, None] + SLACK
                rows, met = _ragged(part["before"])
                where, here = _found_in(at, met)
                inside[rows[here], where[here]] = False
                for bundle, lo, hi in zip(bundles, begins, [*begins[1:], len(at)], strict=True):
                    own = np.flatnonzero(inside[:, lo:hi].any(axis=1))
                    bits = np.zeros((len(own), bit[lo:hi].max() + 1), bool)
                    bits[:, bit[lo:hi]] = inside[own, lo:hi]
                    found.append(pd.DataFrame({QUERY: ids[own], "bundle": bundle, "cells": [x.tobytes() for x in np.packbits(bits, axis=1)]}))
            else:
                angles[~inside] = np.inf
                few = min(probes, len(at))
                rows, where = np.nonzero((angles <= np.partition(angles, few - 1, axis=1)[:, few - 1 :][:, :1]) & inside)
                order = np.lexsort((where, angles[rows, where], rows))
                rows, where = rows[order], where[order]
                best = np.arange(len(rows)) - np.searchsorted(rows, rows) < few
                rows, where = rows[best], where[best]
                own, cuts = np.unique(rows, return_index=True)
                lists = {"ats": np.split(at[where], cuts[1:]), "angles": np.split(angles[rows, where], cuts[1:])} if len(own) else {"ats": [], "angles": []}
                found.append(pd.DataFrame({QUERY: ids[own], **lists}))
        return pd.concat([x for x in found if len(x)] or found[:1], ignore_index=True)

    return run


def _packed(edges: np.ndarray):
    """(query_id, bundle, cells) of (query_id, ats): a bit for each cell of a bundle that the query meets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, at = _ragged(batch["ats"])
            ids, of = batch[QUERY].to_numpy(), np.searchsorted(edges, at, "right") - 1
            for bundle in np.unique(of):
                own, row = np.unique(rows[of == bundle], return_inverse=True)
                bits = np.zeros((len(own), edges[bundle + 1] - edges[bundle]), bool)
                bits[row, at[of == bundle] - edges[bundle]] = True
                yield pd.DataFrame({QUERY: ids[own], "bundle": bundle, "cells": [x.tobytes() for x in np.packbits(bits, axis=1)]})

    return run


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(query_id, bundle, bit) of (query_id, bundle, cells)."""
    for batch in batches:
        for begin in range(0, len(batch), UNPACK):
            part = batch.iloc[begin : begin + UNPACK]
            rows, bit = _ragged(pd.Series([np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))) for x in part["cells"]], dtype=object))
            yield pd.DataFrame({QUERY: part[QUERY].to_numpy()[rows], "bundle": part["bundle"].to_numpy()[rows], "bit": bit})


def _meeting(key: str, k: int):
    """Compare a block of queries with a block of a bundle's vectors: each with those of its own cells that lie within its ``far``.

    Scores are made ``SCORES`` at a time and what they leave is cut to k for each query as soon as it is more than ``HELD``, so ties and
    crowded cells fill no memory.
    """

    def directions(vectors: pd.Series) -> np.ndarray:
        out = np.empty((len(vectors), len(vectors.iloc[0])))
        for row, v in enumerate(vectors):
            out[row] = v
        out /= np.sqrt((out * out).sum(axis=1))[:, None]
        return out

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({QUERY: [], key: [], DISTANCE: []})
        own = right["bit"].to_numpy(np.int64)
        order = np.argsort(own, kind="stable")
        own, names, vectors = own[order], np.asarray(right["key"].tolist())[order], directions(right["v"])[order]
        ranks = np.empty(len(names), np.int64)
        ranks[np.argsort(names, kind="stable")] = np.arange(len(names))
        here, begins = np.unique(own, return_index=True)
        ends = np.append(begins[1:], len(own))
        queries, far = directions(left["v"]), left["far"].to_numpy(np.float64)
        bits = np.frombuffer(b"".join(left["cells"]), np.uint8).reshape(len(left), -1)
        dense = np.bitwise_count(bits).sum() > 0.5 * len(left) * len(here)

        def pieces(met: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
            """Queries and ranges of vectors that are compared with them: all, or cell by cell those that meet it."""
            for lo, hi, asking in [(0, len(own), np.arange(len(met)))] if dense else zip(begins, ends, (np.flatnonzero(met[:, c]) for c in here)):
                for first in range(lo, hi if len(asking) else lo, ACROSS):
                    last = min(first + ACROSS, hi)
                    width = max(1, SCORES // (last - first))
                    for begin in range(0, len(asking), width):
                        yield asking[begin : begin + width], first, last

        def best(held: list, limit: np.ndarray) -> list:
            """The k best of each query; the k-th limits what is looked for from then on."""
            at, item, d = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((ranks[item], d, at))
            at, item, d = at[order], item[order], d[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            limit[at[place == k - 1]] = d[place == k - 1]
            return [(at[place < k], item[place < k], d[place < k])]

        def nearest(rows: np.ndarray, first: int, last: int, asked: np.ndarray, met: np.ndarray, limit: np.ndarray) -> tuple:
            """(row, item, distance) of what may be among the k nearest."""
            scores = asked[rows] @ vectors[first:last].T
            free = np.flatnonzero(np.isinf(limit[rows]))
            if len(free) and last - first >= k:
                few = scores[free]
                if dense:
                    few[~met[rows[free]][:, own[first:last]]] = -np.inf
                limit[rows[free]] = np.round(1.0 - np.partition(few, last - first - k, axis=1)[:, last - first - k], 12)
            until = limit[rows]
            row, item = np.divmod(np.flatnonzero(scores >= (1.0 - until - NEAR)[:, None]), last - first)
            d = np.round(1.0 - scores[row, item], 12)
            real = (d <= until[row]) & met[rows[row], own[first + item]]
            return rows[row[real]], first + item[real], d[real]

        found, step = [], DENSE_ROWS if dense else SPARSE_ROWS
        for begin in range(0, len(queries), step):
            asked, limit = queries[begin : begin + step], far[begin : begin + step].copy()
            met = np.unpackbits(bits[begin : begin + step], axis=1).view(bool)
            held, size = [], 0
            for rows, first, last in pieces(met):
                part = nearest(rows, first, last, asked, met, limit)
                if len(part[0]):
                    held.append(part)
                    size += len(part[0])
                if size > HELD + k * step:
                    held = best(held, limit)
                    size = len(held[0][0])
            for at, item, d in best(held, limit) if held else ():
                found.append((begin + at, item, d))
        if not found:
            return pd.DataFrame({QUERY: [], key: [], DISTANCE: []})
        at, item, d = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({QUERY: left[QUERY].to_numpy()[at], key: names[item], DISTANCE: d})

    return run


def _tile(rows: int) -> int:
    """How many of so many queries or vectors go to a task."""
    return min(TILE, max(TILE_LEAST, math.ceil(rows / TILES)))


class _Bundles:
    """Groups that lie together taken as bundles of about ``TILE`` vectors, and bundles as slices of ``SLICE_CELLS`` cells.

    Cells are numbered (``at``) through all groups, and by ``bit`` in their bundle. There are as many rows as groups, and they are
    broadcast.
    """

    def __init__(self, index: Cells) -> None:
        listed = index.cells.groupBy("grp").agg(F.max("own").alias("last"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"))
        listed = listed.orderBy("grp").collect()
        self.cells = sum(r.cells for r in listed)
        most, at, rows, bundle, slice_, slice_at = _tile(sum(r.n for r in listed)), 0, 0, 0, 0, 0
        edges, places, sizes = [0], [], []
        for r in listed:
            if at > edges[-1] and (rows + r.n > most or at + r.last + 1 - edges[-1] > SLICE_CELLS):
                sizes.append((bundle, math.ceil(rows / most)))
                edges.append(at)
                rows, bundle = 0, bundle + 1
                if at + r.last + 1 - slice_at > SLICE_CELLS:
                    slice_, slice_at = slice_ + 1, at
            places.append((r.grp, bundle, slice_, edges[-1], at - edges[-1]))
            at, rows = at + r.last + 1, rows + r.n
        self.edges, self.slices = np.array([*edges, at]), slice_ + 1
        spark = index.cells.sparkSession
        self.sizes = spark.createDataFrame([*sizes, (bundle, math.ceil(rows / most))], "bundle int, c_blocks int")
        self.places = spark.createDataFrame(places, "grp int, bundle int, slice int, edge int, first int")

    def put(self, rows: DataFrame) -> DataFrame:
        """Adds ``bundle``, ``slice``, ``bit`` and ``at`` to rows that have a group and a cell of it."""
        bit = F.col("first") + F.col("own")
        rows = rows.join(F.broadcast(self.places), "grp").withColumn("bit", bit)
        return rows.withColumn("at", F.col("edge") + F.col("bit")).drop("edge", "first")


def _met(asked: DataFrame, pairs: DataFrame, index: Cells, bundles: _Bundles, k: int, most: int, schema: str) -> DataFrame:
    """Compare queries with the vectors of the cells they are paired with: (query_id, bundle, cells).

    A query goes to a bundle once, with a bit for each cell there, and a bundle's vectors once for each block of ``most`` of its queries;
    a block gives out k rows for each query, however many cells were met.
    """
    counts = pairs.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("q_blocks"))
    sizes = F.broadcast(counts.join(F.broadcast(bundles.sizes), "bundle"))  # a row for each bundle

    def dealt(rows: DataFrame, by: str, mine: str, own: str, theirs: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64(by), F.col(own)).cast("int").alias(mine)
        return rows.join(sizes, "bundle").select(*rows.columns, block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs))

    left = asked.select(QUERY, "v", "far").join(pairs.select(QUERY, "bundle", "cells"), QUERY)
    left = dealt(left, QUERY, "qb", "q_blocks", "cb", "c_blocks")
    right = bundles.put(index.vectors.select("key", "v", "grp", "own")).select("key", "v", "bundle", "bit")
    right = dealt(right, "key", "cb", "c_blocks", "qb", "q_blocks")
    where = ["bundle", "qb", "cb"]
    return left.groupBy(*where).cogroup(right.groupBy(*where)).applyInPandas(_meeting("key", k), schema)


def search(
    index: Cells,
    queries: DataFrame,
    k: int = fixed.SIMILAR_DEFAULT,
    exact: bool = False,
    probe_groups: int = PROBE_GROUPS,
    probes: int = PROBES,
    key: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """(query_id, key, distance) of the k nearest vectors for each query, and the (query_id, cell, n) that were met to find them.

    Without ``exact`` these are the nearest in the query's ``probes`` nearest cells. Queries without an id or a direction are left out;
    ids are those of one query each.
    """
    if k < 1 or probes < 1 or probe_groups < 1:
        raise ValueError("k and the probes must be at least 1")
    spark, scratch = queries.sparkSession, run_dir(queries.sparkSession, "probe")
    schema = _result_schema(queries, index.vectors, "key")
    query_type = schema.split(",")[0]
    asked = _with_direction(queries.where(F.col(QUERY).isNotNull()).select(QUERY, F.col(vector).alias("v")), "v")
    asked = _stored(asked, f"{scratch}/asked")
    if not len(index.groups):
        empty = spark.createDataFrame([], schema).withColumnRenamed("key", key)
        return empty, spark.createDataFrame([], f"{query_type}, cell long, n long")

    count, bundles = asked.count(), _Bundles(index)
    blocks, most = max(PAIR_BLOCKS, math.ceil(count / MEET_QUERIES)), max(1, min(_tile(count), FOUND // k))
    packed = f"{query_type}, bundle int, cells binary"

    def paired(rows: DataFrame, groups, probes: int | None) -> DataFrame:
        """What ``_cells_of`` says of the cells in each query's groups.

        A query goes once to each slice of the groups, of which there is one up to ``SLICE_CELLS`` cells, and not to each group.
        """
        slice_ = F.explode(F.sequence(F.lit(0), F.lit(bundles.slices - 1))).alias("slice")
        block = F.pmod(F.xxhash64(QUERY), F.lit(blocks)).cast("int").alias("block")
        each = rows.select(*rows.columns, groups.alias("groups")).select(*rows.columns, "groups", block, slice_)
        where = ["slice", "block"]
        cells = bundles.put(index.cells.select("grp", "own", "centre", "radius")).drop("own")
        cells = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        sides = each.groupBy(*where).cogroup(cells.groupBy(*where))
        return sides.applyInPandas(_cells_of(probes), packed if probes is None else f"{query_type}, ats array<int>, angles array<double>")

    def cells_met(pairs: DataFrame) -> DataFrame:
        each = pairs.mapInPandas(_unpacked, f"{query_type}, bundle int, bit int")
        return each.join(bundles.put(index.cells.select("grp", "own", "cell", "n")), ["bundle", "bit"]).select(QUERY, "cell", "n")

    everything = probe_groups >= len(index.groups) and probes >= bundles.cells
    if everything:
        whole = bundles.put(index.cells.select("grp", "own")).groupBy(F.lit(0).alias(QUERY)).agg(F.collect_list("at").alias("ats"))
        whole = whole.mapInPandas(_packed(bundles.edges), f"{QUERY} int, bundle int, cells binary").select("bundle", "cells")
        first = asked.select(QUERY).crossJoin(F.broadcast(whole))  # a row for each bundle
    else:
        cells = paired(asked.select(QUERY, "u"), _to_groups(index, probe_groups)(F.col("u"), F.lit(0.0)), probes)
        cells = cells.select(QUERY, F.explode(F.arrays_zip(F.col("ats").alias("at"), F.col("angles").alias("angle"))).alias("c"))
        cells = top_per_key(cells.select(QUERY, "c.at", "c.angle"), [QUERY], [F.col("angle"), F.col("at")], probes)
        before = _stored(cells.groupBy(QUERY).agg(F.sort_array(F.collect_list("at")).alias("before")), f"{scratch}/first")
        first = before.select(QUERY, F.col("before").alias("ats")).mapInPandas(_packed(bundles.edges), packed)

    near = asked.select(QUERY, "v", F.lit(math.inf).alias("far"))
    found = _stored(_ranked(_met(near, first, index, bundles, k, most, schema), "key", k), f"{scratch}/found")
    if everything or not exact:
        return found.withColumnRenamed("key", key), cells_met(first)
    # The angle of the k-th neighbour so far; without k neighbours everything is within reach.
    kth = found.groupBy(QUERY).agg(F.count(F.lit(1)).alias("found"), F.max(DISTANCE).alias("far"))
    kth = kth.select(QUERY, F.when(F.col("found") >= k, F.col("far")).otherwise(F.lit(math.inf)).alias("far"))
    open_ = asked.join(kth, QUERY, "left").withColumn("far", F.coalesce("far", F.lit(math.inf))).join(before, QUERY, "left")
    open_ = open_.withColumn("before", F.coalesce("before", F.array().cast("array<int>")))
    reach = F.when(F.col("far") < math.inf, F.acos(F.greatest(F.lit(-1.0), F.lit(1.0) - F.col("far")))).otherwise(F.lit(4.0))
    open_ = _stored(open_.withColumn("reach", reach), f"{scratch}/open")
    more = paired(open_.select(QUERY, "u", "reach", "before"), _to_groups(index, None)(F.col("u"), F.col("reach")), None)
    more = _stored(more, f"{scratch}/more")
    both = _met(open_, more, index, bundles, k, most, schema).unionByName(found)
    return _ranked(both, "key", k).withColumnRenamed("key", key), cells_met(first).unionByName(cells_met(more))
