"""The stored cell index: exact results, recall, and what has to be met."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import cells
from tidemill.operators import similarity as vectors

ROW = "vec_id bigint, embedding array<double>"
SF = "/root/testdata/sf0.01"


def as_queries(df):
    return df.select(F.col("vec_id").alias(vectors.QUERY), "embedding")


def found(df):
    return sorted((r.query_id, r.vec_id, round(r.distance, 9)) for r in df.collect())


def clusters(spark, groups=8, each=150, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 12)) * 10
    data = [(g * each + i, (centres[g] + rng.normal(size=12) * 0.3).tolist()) for g in range(groups) for i in range(each)]
    return data, spark.createDataFrame(data, ROW).repartition(4)


def test_exact_search_meets_few_cells_of_clustered_vectors(spark, folder):
    data, df = clusters(spark)
    odd = spark.createDataFrame([(9000, None), (9001, [0.0] * 12), (9002, [float("nan")] * 12), (9003, data[5][1])], ROW)
    cells.build(df.unionByName(odd), f"{folder}/index", cell_rows=30)
    index = cells.Cells(spark, f"{folder}/index")
    assert index.cells.count() > 20 and index.vectors.count() == len(data) + 1
    asked = as_queries(df.unionByName(odd).where("vec_id % 7 = 0 or vec_id >= 9000"))
    got, met = cells.search(index, asked, k=6, exact=True, probe_groups=2, probes=2)
    assert found(got) == found(vectors.similar(asked.where("query_id < 9000 or query_id = 9003"), df.unionByName(odd.where("vec_id = 9003")), k=6))
    shipped = met.agg(F.sum("n")).first()[0] / (met.select("query_id").distinct().count() * (len(data) + 1))
    assert shipped < 0.3 and met.distinct().count() == met.count()


def test_all_probes_and_far_queries_are_exact(spark, folder):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=5).tolist()) for i in range(400)] + [(500 + i, [1.0, 1.0, 0.0, 0.0, 0.0]) for i in range(60)]
    df = spark.createDataFrame(data, ROW)
    cells.build(df, f"{folder}/index", cell_rows=25)
    index = cells.Cells(spark, f"{folder}/index")
    asked = as_queries(df.where("vec_id % 5 = 0"))
    want = found(vectors.similar(asked, df, k=70))  # more than any cell holds
    assert found(cells.search(index, asked, k=70, exact=True, probe_groups=1, probes=1)[0]) == want
    assert found(cells.search(index, asked, k=70, probe_groups=99, probes=999)[0]) == want
    assert found(cells.search(index, asked, k=999, exact=True)[0]) == found(vectors.similar(asked, df, k=999))
    with pytest.raises(ValueError):
        cells.search(index, asked, k=0)


def test_recall_at_the_default_and_the_empty_corpus(spark, folder):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    cells.build(df, f"{folder}/index", cell_rows=20)
    index = cells.Cells(spark, f"{folder}/index")
    asked = as_queries(df.where("vec_id % 20 = 0"))
    got, met = cells.search(index, asked, k=10)
    want = {t[:2] for t in found(vectors.similar(asked, df, k=10))}
    assert len(want & {t[:2] for t in found(got)}) >= 0.9 * len(want)
    assert met.groupBy("query_id").count().agg(F.max("count")).first()[0] <= cells.PROBES
    cells.build(df.limit(0), f"{folder}/none")
    nothing, met = cells.search(cells.Cells(spark, f"{folder}/none"), asked, k=10, exact=True)
    assert nothing.columns == ["query_id", "vec_id", "distance"] and nothing.count() == met.count() == 0


def test_shuffled_queries_grow_with_groups_and_not_with_cells(spark, folder):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=6).tolist()) for i in range(900)]
    df = spark.createDataFrame(data, ROW)
    cells.build(df, f"{folder}/index", cell_rows=10)
    index = cells.Cells(spark, f"{folder}/index")
    asked = as_queries(df.where("vec_id % 3 = 0"))
    want = found(vectors.similar(asked, df, k=4))
    sent = []

    def counted(k, *rest, real=cells._meeting):
        run, seen = real(k, *rest), spark.sparkContext.accumulator(0)
        sent.append(seen)

        def noted(left, right):
            seen.add(len(left))
            return run(left, right)

        noted.__annotations__ = {}
        return noted

    plain, cells._meeting = cells._meeting, counted
    try:
        got, met = cells.search(index, asked, k=4, probe_groups=99, probes=999)
        assert found(got) == want and found(cells.search(index, asked, k=4, exact=True, probe_groups=1, probes=2)[0]) == want
    finally:
        cells._meeting = plain
    groups = len(index.groups)
    assert met.count() == 300 * index.cells.count() >= 300 * 6 * groups
    assert 0 < sent[0].value <= 300 * groups


def test_queries_choose_their_cells_of_all_groups_at_once(spark, folder, monkeypatch):
    """A query's direction went to each of its groups, which was most of what an exact search shuffled."""
    data, df = clusters(spark, groups=4, each=60)
    cells.build(df, f"{folder}/index", cell_rows=15)
    index = cells.Cells(spark, f"{folder}/index")
    asked = as_queries(df.where("vec_id % 4 = 0"))
    want, n, real = found(vectors.similar(asked, df, k=4)), asked.count(), cells._cells_of
    for most, slices in ((20_000, 1), (index.cells.count() // 2, 3)):
        monkeypatch.setattr(cells, "SLICE_CELLS", most)
        seen = spark.sparkContext.accumulator(0)

        def counted(probes, seen=seen):
            run = real(probes)

            def noted(left, right):
                seen.add(len(left))
                return run(left, right)

            noted.__annotations__ = {}
            return noted

        monkeypatch.setattr(cells, "_cells_of", counted)
        assert found(cells.search(index, asked, k=4, exact=True, probe_groups=3, probes=2)[0]) == want
        assert 2 * n <= seen.value <= 2 * n * slices < 2 * n * len(index.groups) * slices


def most_mb(run, *rows):
    """The most that a task's function held at a time, and what it returned."""
    tracemalloc.start()
    try:
        out = run(*rows)
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_cells_within_reach_are_bits_and_not_lists():
    """Where no bound spares a cell, a task held a list of all cells for each of its queries."""
    rng = np.random.default_rng(4)
    queries, groups, within = 4_000, 40, 50
    asked = pd.DataFrame({"query_id": range(queries), "u": list(rng.normal(size=(queries, 4))), "reach": 4.0})
    asked["groups"], asked["before"] = [np.arange(groups)] * queries, [np.array([3, 7])] * queries
    at = np.arange(groups * within)
    shown = pd.DataFrame({"grp": at // within, "own": at % within, "centre": list(rng.normal(size=(len(at), 4))), "radius": 0.5})
    shown = shown.assign(at=at, bundle=at // 1_000, bit=at % 1_000)
    mb, out = most_mb(cells._cells_of(None), asked, shown)
    assert mb < 40
    assert len(out) == 2 * queries and {len(x) for x in out["cells"]} == {125}
    assert sum(np.bitwise_count(np.frombuffer(x, np.uint8)).sum() for x in out["cells"]) == queries * (len(at) - 2)


@pytest.mark.parametrize("share", [1.0, 0.1])
def test_ties_are_cut_as_they_are_found(share):
    """All vectors at one distance of all queries were held before the k best were taken."""
    n, k, cells_ = 3_000, 5, 100
    one, rng = np.array([3.0, 4.0]), np.random.default_rng(6)
    met = rng.random((n, cells_)) < share
    left = pd.DataFrame({"query_id": range(n), "v": [one] * n, "far": math.inf})
    left["cells"] = [x.tobytes() for x in np.packbits(met, axis=1)]
    right = pd.DataFrame({"key": rng.permutation(n), "v": [one] * n, "bit": rng.integers(0, cells_, n)})
    mb, out = most_mb(cells._meeting("key", k), left, right)
    assert mb < 60 * max(share, 0.5)
    keys = right.sort_values("key")
    want = [(q, key) for q in range(0, n, 100) for key in keys["key"][met[q][keys["bit"]]].head(k)]
    out = out[out["query_id"] % 100 == 0]
    assert sorted(zip(out["query_id"], out["key"])) == sorted(want) and (out["distance"] == 0).all()


def test_bundles_and_slices_meet_every_cell_once(spark, folder, monkeypatch):
    rng = np.random.default_rng(8)
    data = [(i, rng.normal(size=6).tolist()) for i in range(700)] + [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0]) for i in range(200)]
    df = spark.createDataFrame(data, ROW)
    cells.build(df, f"{folder}/index", cell_rows=15)
    index = cells.Cells(spark, f"{folder}/index")
    asked = as_queries(df.where("vec_id % 3 = 0"))
    want = found(vectors.similar(asked, df, k=4))
    for name, value in (("TILE_LEAST", 60), ("SLICE_CELLS", 25), ("HELD", 8), ("ACROSS", 16), ("SCORES", 256), ("SPARSE_ROWS", 32)):
        monkeypatch.setattr(cells, name, value)
    bundles = cells._Bundles(index)
    blocks = [r.c_blocks for r in bundles.sizes.collect()]
    assert len(blocks) > 3 and max(blocks) > 1 and bundles.slices > 1
    got, met = cells.search(index, asked, k=4, exact=True, probe_groups=2, probes=3)
    assert found(got) == want
    assert met.distinct().count() == met.count() <= asked.count() * index.cells.count()
    assert found(cells.search(index, asked, k=4, probe_groups=99, probes=999)[0]) == want
