"""Best items by factors against all pairs."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tidemill.operators import factors

ROW = "id bigint, features array<double>"


def brute(users, items, k):
    want = {}
    for u, x in users:
        scored = sorted(((-float(np.dot(x, y)), i) for i, y in items))
        want[u] = [(i, -s) for s, i in scored[:k]]
    return want


def run(spark, users, items, k, **kw):
    found, work = factors.top_items(spark.createDataFrame(users, ROW).repartition(3), spark.createDataFrame(items, ROW), k, **kw)
    got = {}
    for r in found.collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    return {u: sorted(v, key=lambda p: (-p[1], p[0])) for u, v in got.items()}, work


@pytest.mark.parametrize("chunks", [(1, 1), (7, 30), (512, 512)])
def test_equal_to_all_pairs(spark, chunks):
    rng = np.random.default_rng(4)
    # Small whole numbers: many ties, and scores without rounding; users of length 0, copies of items.
    users = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(40)] + [(99, [0.0] * 4)]
    items = [(i, (rng.integers(-2, 3, 4) * rng.integers(1, 9)).astype(float).tolist()) for i in range(60)]
    items += [(100 + i, items[5][1]) for i in range(20)]
    got, work = run(spark, users, items, 5, first=chunks[0], most=chunks[1])
    assert got == brute(users, items, 5)
    assert work.pairs == 41 * 80 and 0 < work.scored <= work.pairs


def test_few_long_items_spare_most_pairs(spark):
    rng = np.random.default_rng(5)
    users = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    items = [(i, (rng.normal(size=8) * (40 if i % 50 == 0 else 1)).tolist()) for i in range(4000)]
    got, work = run(spark, users, items, 10, first=256, most=1024)
    want = brute(users, items, 10)
    assert {u: [i for i, _ in v] for u, v in got.items()} == {u: [i for i, _ in v] for u, v in want.items()}
    assert work.share < 0.15


def test_few_items_and_rows_that_take_no_part(spark):
    users = [(1, [1.0, 2.0]), (None, [1.0, 1.0]), (2, None), (3, [1.0, None])]
    items = [(7, [1.0, 0.0]), (8, [0.0, -1.0]), (None, [9.0, 9.0]), (9, None)]
    assert run(spark, users, items, 10)[0] == {1: [(7, 1.0), (8, -2.0)]}
    assert run(spark, users, items[2:], 10) == ({}, factors.Work(0, 0))
    assert run(spark, users[1:], items, 10)[0] == {}
    with pytest.raises(ValueError):
        factors.top_items(spark.createDataFrame(users, ROW), spark.createDataFrame(items, ROW), 0)


def test_a_task_holds_few_scores_however_long_the_chunk():
    class Chunk:
        rng = np.random.default_rng(6)
        value = (np.arange(20_000), rng.normal(size=(20_000, 4)))

    n = 3_000
    users = pd.DataFrame({"user_id": np.arange(n), "u": list(Chunk.rng.normal(size=(n, 4)))})
    users["item_ids"], users["scores"] = [np.zeros(0, np.int64)] * n, [np.zeros(0)] * n
    tracemalloc.start()
    met = pd.concat(factors._meeting(Chunk, 3, -1.0)(iter([users])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 < 8 * n * 20_000
    for r in met.iloc[::500].itertuples():
        scores = Chunk.value[1] @ r.u
        assert list(r.item_ids) == list(np.argsort(-scores)[:3]) and not r.open
