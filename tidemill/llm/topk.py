"""Exact top-k search by inner product over multi-resolution segment statistics.

Vectors are cut into equal segments, coarse ones and finer ones. For two vectors, segment means and deviations give a lower bound on their
distance, and with it an upper bound on their inner product: within a segment of m components it is at most m times (product of the
means + product of the deviations). A block of queries meets a block of candidates in one task. The coarse bound is computed
for all pairs at once; exact products of each query's most promising candidates give a score that its k-th best cannot fall
below; only candidates whose coarse bound reaches it get the finer bound, and only those that still reach it an exact product.

Components become floor(scale * x). Vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows without an
id. Shorter vectors count as padded with zeros. A row never meets rows of its own id; equal (id, score) results of one query count once, so
repeated rows change nothing. Ties go to the smaller id. Scores are exact while they fit in a long.

Blocks are dealt by a hash of the id and have about ``block_rows`` rows, however ids are spread; each is packed into one binary value. Every
candidate block is sent to every query block, which the stated query set (all rows against all) asks for; nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import settle

SEGMENTS = (16, 4)  # components of a segment, from coarse to fine
BLOCK_QUERIES, BLOCK_ROWS = 1024, 8192
_PACKED = "block int, ids binary, vectors binary, dim int"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & fine, whole)


def _pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    rows = part["v"].tolist()
    dim = max(len(r) for r in rows)
    block = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        block[i, : len(r)] = r
    ids = part["id"].to_numpy(np.int64)
    return pd.DataFrame({"block": [int(key[0])], "ids": [ids.tobytes()], "vectors": [block.tobytes()], "dim": [dim]})


def _blocks(rows: DataFrame, size: int, count: int) -> DataFrame:
    blocks = max(1, -(-count // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(_pack, _PACKED)


def _statistics(x: np.ndarray, width: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that a plain product of two rows is the upper bound."""
    parts = [x[:, at : at + width] for at in range(0, x.shape[1], width)]
    means = [np.sqrt(p.shape[1]) * p.mean(axis=1) for p in parts]
    deviations = [np.sqrt(p.shape[1]) * p.std(axis=1) for p in parts]
    return np.stack(means + deviations, axis=1)


def best_of(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, segments: tuple[int, ...] = SEGMENTS) -> list[tuple]:
    """(query id, candidate id, score) of the k best candidates of each query; equal (id, score) once."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    slack = 1e-9 * most + 1e-6  # for rounding in the bounds
    exact = (c.astype(np.float64), q.astype(np.float64)) if most < 2.0**52 else (c, q)
    stats = [(_statistics(q.astype(np.float64), w), _statistics(c.astype(np.float64), w)) for w in segments]
    coarse = stats[0][0] @ stats[0][1].T
    found = []
    for i, own in enumerate(q_ids.tolist()):
        bound = coarse[i]
        bound[c_ids == own] = -np.inf
        promising = np.argpartition(-bound, min(4 * k, len(bound) - 1))[: 4 * k]
        promising = promising[bound[promising] > -np.inf]
        first = np.unique(np.stack([c_ids[promising], (exact[0][promising] @ exact[1][i]).astype(np.int64)], 1), axis=0)
        enough = np.sort(first[:, 1])[-k] if len(first) >= k else -np.inf
        left = np.flatnonzero((bound >= enough - slack) & (bound > -np.inf))
        for fine_q, fine_c in stats[1:]:
            left = left[fine_c[left] @ fine_q[i] >= enough - slack]
        scores = (exact[0][left] @ exact[1][i]).astype(np.int64)
        good = scores >= enough
        pairs = np.unique(np.stack([-scores[good], c_ids[left][good]], 1), axis=0)[:k]
        found += [(own, cid, -score) for score, cid in pairs.tolist()]
    return found


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all other rows for every row whose id is divisible by ``every``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = settle(vectors.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    asked = F.pmod(F.col("id"), F.lit(every)) == 0
    count = rows.agg(F.count("*").alias("all"), F.count_if(asked).alias("asked")).first()
    queries = _blocks(rows.where(asked), block_queries, count["asked"])
    candidates = _blocks(rows, block_rows, count["all"])
    n = max(1, -(-count["all"] // block_rows))
    cells = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.struct("ids", "vectors", "dim").alias("q")).join(
        candidates.select("block", F.struct("ids", "vectors", "dim").alias("c")), "block"
    )

    def meet(parts):
        for part in parts:
            for q, c in zip(part["q"], part["c"], strict=True):
                dim = max(q["dim"], c["dim"])
                sides = []
                for s in (q, c):
                    x = np.frombuffer(s["vectors"], np.int64).reshape(-1, s["dim"])
                    sides += [np.frombuffer(s["ids"], np.int64), np.pad(x, ((0, 0), (0, dim - s["dim"])))]
                yield pd.DataFrame(best_of(*sides, k), columns=["query_id", "vec_id", "score"])

    spread = cells.repartition(F.col("block"), F.xxhash64(F.col("q.ids")))
    hits = spread.mapInPandas(meet, "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
