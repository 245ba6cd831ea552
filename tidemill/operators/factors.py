"""The k items with the largest inner product for every user, exactly and without scoring all pairs.

Items are ranked by the length of their factors, longest first, and taken in chunks. In a round all open users meet one chunk:
a matrix product in each task gives its scores, and every user keeps the k best so far. No score of a later chunk can exceed the
user's length times the length of that chunk's first item, so a user whose k-th score is above this is done. Where a few items
are long, as popular ones are, most users are done after the first chunks; where all are alike every pair is scored.

A chunk, of at most ``MOST`` items, is all that is broadcast. Users and their best items are written after each round to the
shared folder, which cuts the lineage; rounds that are over are read back as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.session import run_dir

FIRST, MOST = 2_048, 65_536  # items of the first chunk, and of any
CELLS = 1 << 20  # scores that a task holds at a time
SLACK = 1e-9  # of a bound, for rounding
_STATE = "user_id long, u array<double>, item_ids array<bigint>, scores array<double>, open boolean"


@dataclass(frozen=True)
class Work:
    """How many pairs were scored, of how many there are."""

    scored: int
    pairs: int

    @property
    def share(self) -> float:
        return self.scored / self.pairs if self.pairs else 0.0


def _length(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def _ranked(items: DataFrame, root: str) -> tuple[DataFrame, int]:
    """(rank, item_id, v, length), the longest first and of equal ones the smallest id; and how many there are."""
    spark = items.sparkSession
    rows = items.select(F.col("id").cast("long").alias("item_id"), F.col("features").cast("array<double>").alias("v")).withColumn("length", _length("v"))
    order = [F.col("length").desc(), F.col("item_id")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{root}/sorted")
    rows = spark.read.parquet(f"{root}/sorted")
    part = F.shiftright("at", 33)
    counts = dict(sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect()))  # one for each partition
    if not counts:
        return rows.withColumn("rank", F.lit(0).cast("long")), 0
    begins = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist(), strict=False))
    begin = F.create_map(*[F.lit(x) for pair in begins.items() for x in pair])
    ranked = rows.withColumn("rank", F.element_at(begin, part) + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at")
    ranked.write.parquet(f"{root}/items")
    return spark.read.parquet(f"{root}/items"), sum(counts.values())


def _best(scores: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, score, id) of every score that may be among the k best of its row: none below ``least`` or below the row's k-th."""
    if scores.shape[1] > k and np.isneginf(least).any():
        least = np.maximum(least, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])  # its ties stay in
    at, item = np.nonzero(scores >= least[:, None])
    return at, scores[at, item], ids[item]


def _meeting(chunk, k: int, rest: float, cells: int = CELLS):
    """Score open users against a chunk; ``rest`` is the length of the longest item after it.

    So many users at a time that no more than ``cells`` scores are held, however long the chunk is.
    """

    def meet(part: pd.DataFrame, ids: np.ndarray, v: np.ndarray) -> pd.DataFrame:
        u = np.stack(part["u"].to_numpy())
        sizes = np.array([len(s) for s in part["scores"]])
        least = np.array([s[-1] if len(s) == k else -np.inf for s in part["scores"]])
        found = _best(u @ v.T, ids, least, k)
        held = (np.repeat(np.arange(len(u)), sizes), np.concatenate([*part["scores"]]), np.concatenate([*part["item_ids"]]).astype(np.int64))
        at, scores, names = (np.concatenate(pair) for pair in zip(held, found, strict=True))
        order = np.lexsort((names, -scores, at))  # higher score first, of equal ones the smaller id
        at, scores, names = at[order], scores[order], names[order]
        begins = np.searchsorted(at, np.arange(len(u)))
        best = np.arange(len(at)) - begins[at] < k
        at, scores, names = at[best], scores[best], names[best]
        ends = np.searchsorted(at, np.arange(1, len(u)))
        scores, names = np.split(scores, ends), np.split(names, ends)
        kth = np.array([s[-1] if len(s) == k else -np.inf for s in scores])
        bound = np.linalg.norm(u, axis=1) * rest * (1 + SLACK) + SLACK * 1e-3
        return pd.DataFrame(
            {"user_id": part["user_id"].to_numpy(), "u": list(u), "item_ids": names, "scores": scores, "open": (bound >= kth) & (rest >= 0)}
        )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, v = chunk.value
        width = max(1, cells // max(1, len(ids)))
        for part in parts:
            for begin in range(0, len(part), width):
                yield meet(part.iloc[begin : begin + width], ids, v)

    return run


def top_items(users: DataFrame, items: DataFrame, k: int = 10, first: int = FIRST, most: int = MOST) -> tuple[DataFrame, Work]:
    """(user_id, item_id, score) of each user's k best items, fewer if there are fewer; and the work it took.

    ``users`` and ``items`` have id and features, all of one length. Rows without an id or features take no part, nor do features with
    a component that is NULL. Ties go to the smaller item.
    """
    if k < 1 or not 1 <= first <= most:
        raise ValueError("k and the chunks must be positive, and the first chunk no longer than the others")
    spark, root = users.sparkSession, run_dir(users.sparkSession, "factors")
    whole = F.col("id").isNotNull() & F.col("features").isNotNull() & ~F.exists("features", lambda x: x.isNull())
    ranked, total = _ranked(items.where(whole), root)
    none = F.array()
    state = users.where(whole).select(
        F.col("id").cast("long").alias("user_id"), F.col("features").cast("array<double>").alias("u"), none.cast("array<bigint>").alias("item_ids"),
        none.cast("array<double>").alias("scores"), F.lit(True).alias("open"),
    )
    begin, size, scored, all_users, done = 0, first, 0, None, []
    while begin < total:
        end = min(begin + size, total)
        rows = ranked.where((F.col("rank") >= begin) & (F.col("rank") < end)).select("item_id", "v").collect()
        after = ranked.where(F.col("rank") == end).select("length").first()
        chunk = spark.sparkContext.broadcast((np.array([r.item_id for r in rows], np.int64), np.array([r.v for r in rows], np.float64)))
        seen = Observation()
        met = state.mapInPandas(_meeting(chunk, k, -1.0 if after is None else after.length), _STATE)
        met = met.observe(seen, F.count(F.lit(1)).alias("users"), F.count_if("open").alias("open"))
        met.write.parquet(f"{root}/round-{len(done)}")
        count, still = seen.get["users"], seen.get["open"]
        all_users = count if all_users is None else all_users
        scored += count * (end - begin)
        held = spark.read.parquet(f"{root}/round-{len(done)}")
        done.append(held.where(~F.col("open")))
        chunk.unpersist()
        if not still:
            break
        state, begin, size = held.where("open"), end, min(2 * size, most)
    if not done:
        return spark.createDataFrame([], "user_id long, item_id long, score double"), Work(0, 0)
    best = done[0]
    for more in done[1:]:
        best = best.unionByName(more)
    pairs = F.explode(F.arrays_zip(F.col("item_ids").alias("item_id"), F.col("scores").alias("score"))).alias("p")
    return best.select("user_id", pairs).select("user_id", "p.item_id", "p.score"), Work(scored, all_users * total)
