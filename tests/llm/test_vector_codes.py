"""Vector codes against a plain version in Python's own integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tidemill.llm import vector_codes as vc
from tidemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def plain(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error) of every kept row, and the digest of the codebooks."""
    kept = [(i, label, v) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**30 for x in v)]
    longest = max((len(v) for _, _, v in kept), default=0)
    w = max(1, -(-longest // parts))
    ints = [[math.floor(1024 * x) for x in v] + [0] * (w * parts - len(v)) for _, _, v in kept]
    order = sorted((i for i in range(len(kept)) if kept[i][0] is not None), key=lambda i: (kept[i][0], ints[i]))[:entries]
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(ints[i], p) for i in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((far(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)] for v in ints]

    for _ in range(rounds):
        members = defaultdict(list)
        for v, found in zip(ints, assign(), strict=True):
            for p, (_, k) in enumerate(found):
                members[p, k].append(cut(v, p))
        for (p, k), own in members.items():
            books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, totals = [], defaultdict(int)
    for (i, label, _), found in zip(kept, assign(), strict=True):
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        totals[label] += out[-1][2]
    long = 2**63 - 1
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, min(e, long), min(totals[label], long)) for i, c, e, label in out], key=repr), digest


def ours(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int").repartition(3)
    books = vc.train(df, **kw)
    coded = vc.with_label_errors(vc.encode(df, books, label_col="label"))
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    return sorted([(r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()], key=repr), books.digest()


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 16])
def test_transform_keeps_distances_and_orders_by_sign_changes(width):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-(2**20), 2**20, (2, 50, width))
    x, y = vc.transform(a), vc.transform(b)
    assert (((x - y) ** 2).sum(1) == x.shape[1] * ((a - b) ** 2).sum(1)).all()
    size = x.shape[1]
    rows = vc.transform(np.eye(size, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(size))


def test_nearest_equals_all_distances_and_eliminates():
    rng = np.random.default_rng(1)
    smooth = np.cumsum(rng.integers(-30, 31, (3000, 16)), axis=1) + rng.integers(-9000, 9000, (3000, 1))
    for x, c in ((smooth, smooth[:256]), (rng.integers(-2, 2, (2000, 6)), rng.integers(-2, 2, (256, 6))), (smooth[:5], smooth[:1])):
        visited = []
        index, distance = vc.nearest(vc.transform(x), vc.transform(c), visited=visited)
        every = ((x[:, None, :] - c[None]) ** 2).sum(2)
        size = vc.transform(c).shape[1]
        assert (index == every.argmin(1)).all() and (distance == size * every.min(1)).all()
        if x is smooth:  # 4 of 16 coefficients for all entries, and little more
            assert sum(visited) < 0.3 * len(x) * len(c) * 16
    huge = smooth[:300] * 2**26
    index, distance = vc.nearest(vc.transform(huge), vc.transform(huge[:50]))
    every = ((huge[:, None, :].astype(object) - huge[None, :50].astype(object)) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (distance == 16 * every.min(1)).all()


def test_against_plain(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8)], int(i) % 3 or None) for i in rng.permutation(400)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[1][1], None), (900, None, 1), (901, [NAN] * 8, 1), (902, [1.0, INF] * 4, 2), (903, [1.0, None] * 4, 2)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, rows, parts=2, entries=7, rounds=2) == plain(rows, 2, 7, 2)


def test_odd_lengths_and_sizes(spark):
    rows = [(1, [0.5, -0.5, 3.0], 1), (2, [], None), (3, [1e9, -1e9, 1.0, 2.0, 5.0], 1), (4, [2e9], 1), (5, [7.0], None), (-9, [-1e-9], 1)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, rows[:1]) == plain(rows[:1])


def test_ties_and_empty(spark):
    rows = [(i, [float(i % 2)] * 4, 0) for i in range(300)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == plain([]) == ([], hashlib.sha256(b"").hexdigest())
    assert ours(spark, [(1, None, 1)])[0] == []


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, digest = plain(rows)
    got = QUERIES["op11_vector_codes"](spark, SF).collect()
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=repr) == want
    assert {r.codebooks_sha256 for r in got} == {digest}
