"""Exact top-k search, the Jaccard join and decontamination against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import decontaminate, jaccard, topk
from tidemill.llm.common import Scratch

VECTORS = "vec_id long, embedding array<float>, rank string"
DOCS = "doc_id long, text string, n_words string, key string"


def best(rows, k, every=20):
    fine = {(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in fine:
        if q % every == 0:
            pairs = {(-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q}
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(pairs)[:k])}
    return out


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 7)])
def test_top_k(spark, blocks):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=24)], "x") for i in range(120)]
    rows += [rows[5], rows[20], (200, [1.0] * 24, ""), (201, [1.0] * 24, ""), (202, [1.0] * 24, "")]  # repeated rows and ties
    rows += [(300, None, ""), (301, [float("nan")] * 24, ""), (302, [None] * 24, ""), (303, [float("inf")] * 24, ""), (None, [1.0] * 24, ""), (304, [], "")]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), 20, block_queries=blocks[0], block_rows=blocks[1]).collect()
    assert {tuple(r) for r in got} == best(rows, 20) and len(got) == len(best(rows, 20))


def test_top_k_small_and_large(spark):
    few = [(0, [1e7, -2e7], ""), (20, [3e7, 1e7], ""), (7, [1e7, 1e7], "")]
    assert {tuple(r) for r in topk.top_k(spark.createDataFrame(few, VECTORS)).collect()} == best(few, 20)
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame(few, VECTORS), 0)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-90, 90, (40, 30)).astype(float), rng.integers(-90, 90, (50, 30)).astype(float)
    for width in (16, 4, 7):
        assert (topk._statistics(a, width) @ topk._statistics(b, width).T >= a @ b.T - 1e-6).all()


def shingles(text, size=4):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def groups(rows, size=4, num=85):
    """(doc_id, size, component) of every row by comparing all pairs."""
    sets = [(r[0], shingles(r[1], size)) for r in rows]
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= num * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, len(s), low.get(top(i))) for i, (d, s) in enumerate(sets)), key=repr)


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows, common = [], " ".join(rng.choices(words, k=30))
    for base in range(30):
        text = rng.choices(words, k=rng.choice([4, 9, 10, 12, 16, 20, 60, 200]))
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy.pop()
            rows.append((len(rows), " ".join(copy) + (" " + common if base % 4 == 0 else "")))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    rows = near_copies(seed)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE Two"), (905, "w1 w2 w3"), (None, rows[0][1]), (None, "alone w1 w2 w3 w4")]
    rows += [rows[3], rows[3], (910, "long " * 30_000)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)
    got = sorted((tuple(r) for r in jaccard.components(df).collect()), key=repr)
    assert got == groups(rows)


@pytest.mark.parametrize(("size", "num"), [(5, 80), (2, 50)])
def test_jaccard_components_of_other_sizes(spark, size, num):
    rows = near_copies(size)
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), size=size, at=jaccard.Threshold(num, 100)).collect()
    assert sorted(map(tuple, got), key=repr) == groups(rows, size, num)


def test_jaccard_links(spark):
    rows = [*near_copies(3), (900, None), (901, "one two"), (None, "alone w1 w2 w3 w4"), (902, "alone w1 w2 w3 w4")]
    rows = [*rows, rows[3], rows[3]]
    pairs, member = jaccard.links(spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS), at=jaccard.Threshold(1, 2))
    sets = {shingles(t) for _, t in rows} - {frozenset()}
    want = {}
    for a, b in itertools.combinations(sets, 2):
        if 2 * len(a & b) >= len(a | b):
            want[frozenset((a, b))] = (len(a & b), len(a | b))
    text = dict(rows)
    classes = {}
    for r in member.collect():
        own = shingles("alone w1 w2 w3 w4" if r.doc_id is None else text[r.doc_id])
        assert r.n_shingles == len(own) and r.n_links == sum(own in p for p in want) and (r.class_id is None) == (not own)
        assert classes.setdefault(r.class_id, own) == own
    assert member.count() == len(rows) and len(set(classes.values())) == len(classes)
    found = pairs.collect()
    assert all(p.class_a < p.class_b for p in found) and len(found) == len(want) > 20
    assert {frozenset((classes[p.class_a], classes[p.class_b])): (p.n_common, p.n_union) for p in found} == want


def family(n, words=300):
    """Copies of one text with a tenth of it changed at places of their own, so most are linked with the text and not with each other."""
    rng = random.Random(n)
    base = [f"b{i}" for i in range(words)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        copy = list(base)
        for at in rng.sample(range(words), 6):
            copy[at] = f"x{rng.random()}"
        rows.append((i, " ".join(copy)))
    return rows


def test_a_pair_meets_once_however_many_lists_it_shares(spark):
    rows = family(80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    join = jaccard._Join(df, "text", "doc_id", 4, jaccard.AT, scratch)
    met = []
    join.verified = lambda pairs: met.append(pairs) or pairs
    join.met(join.shared.select("token", "key", "place").withColumn("label", F.col("key")))
    plain = join.shared.groupBy("token").count().selectExpr("sum(count * (count - 1) / 2) as n").first().n
    text = met[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" in text
    member = spark.read.parquet(f"{scratch.root}/{scratch.count}")
    a, b = (member.select("token", F.col("key").alias(f"{s}key"), F.col("earlier").alias(f"{s}earlier")) for s in "ab")
    once = a.join(b, "token").where((F.col("akey") < F.col("bkey")) & ~F.arrays_overlap("aearlier", "bearlier"))
    assert once.count() < 0.25 * plain and once.count() < 3 * once.select("akey", "bkey").distinct().count()
    scratch.drop()
    assert sorted(map(tuple, jaccard.components(df).collect()), key=repr) == groups(rows)


def test_jaccard_leaves_only_its_result(spark, tmp_path):
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    jaccard.components(spark.createDataFrame(near_copies(4), "doc_id long, text string"))
    left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before
    assert [n.split("-")[0] for n in left] == ["components"]


def test_jaccard_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.components(empty).count() == 0
    assert [df.count() for df in jaccard.links(empty)] == [0, 0]


def test_every_light_pair_shares_a_subset():
    for n in range(1, 20):
        for t in range(n, 20):
            need = jaccard.least_overlap(n, t)
            if need <= n and not n == t == need:
                assert need in jaccard.subset_sizes(n) and need in jaccard.subset_sizes(t)


def test_roots_of_a_chain_and_a_ring(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (102, 101), (101, 100), (7, 7)]
    got = {r.key: r.root for r in jaccard.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100, 102: 100}


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[j : j + 13]), set()).update([] if i is None else [str(i)])
    out = []
    for d, t in docs:
        w, ids = words(t), set()
        hit = [False] * len(w)
        for size in {len(x) for x in windows}:
            for j in range(len(w) - size + 1):
                if tuple(w[j : j + size]) in windows:
                    hit[j : j + size] = [True] * size
                    ids |= windows[tuple(w[j : j + size])]
        n = sum(hit)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), n, len(ids), digest, n > 0 and 20 * n >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pass_bytes", [1 << 26, 600])
def test_contamination(spark, pass_bytes):
    rng = random.Random(5)
    vocabulary = ["a", "bb", "ccc", "Dé", "ß9", "the", "of"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([1, 2, 5, 12, 13, 14, 20, 40, 30])]
    items += [(9, None), (10, " -- "), (11, items[6][1]), (2, "the THE the"), (None, "of of of of")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 30, 200])))) for i in range(20)]
    docs += [(50 + i, "x, y! " * rng.choice([0, 3, 300]) + (t or "").upper().replace(" ", "\n") + " zz") for i, (_, t) in enumerate(items)]
    docs += [(None, None), (98, ""), (99, "..."), docs[0], docs[0], (97, "the " * 40_000)]
    df = spark.createDataFrame([(*d, "clash", "clash") for d in docs], DOCS)
    found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"), pass_bytes=pass_bytes)
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(got, key=repr) == contaminated(docs, items)
    assert "key" in found.columns


def test_contamination_empty(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, items).count() == 0
    row = decontaminate.contamination(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(9)
    text = "".join(rng.choices("ab", k=400)).encode()
    patterns = {text[i : i + rng.choice([1, 2, 3, 7, 8, 9, 30])] for i in range(0, 360, 9)} | {b"bbbbbbbbbbbbbbb"}
    want = {(i, p) for p in patterns for i in range(len(text)) if text.startswith(p, i)}
    assert set(decontaminate.WuManber(patterns).find(text)) == want
