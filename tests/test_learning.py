from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from tidemill.functions import normalised
from tidemill.operators import recommend, search
from tidemill.operators import similarity as vectors
from tidemill.session import BATCH_SETTINGS


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(300, 8)).astype(np.float32)
    matrix[100:200] = matrix[0]  # a third of all vectors are copies
    data = [(int(i), [float(x) for x in v]) for i, v in enumerate(matrix)]
    data += [(1000, [0.0] * 8), (1001, None)]
    return matrix, spark.createDataFrame(data, "vec_id bigint, embedding array<float>").repartition(5).cache()


def by_hand(matrix, queries, k):
    unit = matrix.astype(np.float64) / np.linalg.norm(matrix.astype(np.float64), axis=1, keepdims=True)
    out = {}
    for q in queries:
        d = np.round(1 - unit @ unit[q], 12)
        order = sorted(range(len(d)), key=lambda i: (d[i], i))[:k]
        out[q] = [(i, d[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.distance, r.vec_id)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.distance))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in want[q]], abs=1e-9)


def as_queries(df):
    return df.select(F.col("vec_id").alias("query_id"), "embedding")


def test_few_queries_scan_the_corpus_in_place(corpus):
    matrix, df = corpus
    got = vectors.similar(as_queries(df.where("vec_id in (0, 5, 150)")), df, k=7)
    same(found(got), by_hand(matrix, [0, 5, 150], 7))
    text = plan(got, "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "WindowGroupLimit" in text


def test_many_queries_are_dealt_in_blocks(corpus, monkeypatch):
    matrix, df = corpus
    monkeypatch.setattr(vectors, "BROADCAST_QUERIES", 10)
    got = vectors.similar(as_queries(df), df, k=5, corpus_block=40, query_block=30)
    same(found(got), by_hand(matrix, range(300), 5))
    text = plan(got, "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_k_is_positive_and_has_no_upper_limit(corpus):
    matrix, df = corpus
    with pytest.raises(ValueError, match="k must be"):
        vectors.similar(as_queries(df), df, k=0)
    same(found(vectors.similar(as_queries(df), df, k=25)), by_hand(matrix, range(300), 25))


def test_all_cells_probed_is_exact_and_few_cells_mostly_right(corpus):
    matrix, df = corpus
    want = by_hand(matrix, range(300), 5)
    same(found(vectors.similar_approx(as_queries(df), df, lists=6, probes=6, corpus_block=40, query_block=50)), want)
    got = found(vectors.similar_approx(as_queries(df), df, lists=6, probes=3))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) > 0.7


def test_embedding(spark):
    docs = spark.createDataFrame([(1, "red cup"), (2, "blue pen red"), (3, None), (4, "red cup")], "id bigint, t string")
    got = {r.id: np.array(r.embedding) for r in vectors.embed_hashed(docs, "id", "t").collect()}
    assert all(len(v) == 384 for v in got.values())
    assert np.allclose(got[1], got[4]) and np.linalg.norm(got[2]) == pytest.approx(1, abs=1e-5) and not got[3].any()

    def make():
        return lambda texts: np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

    assert rows(vectors.embed(docs, "id", "t", make)) == [(1, [7.0, 1.0]), (2, [12.0, 1.0]), (3, [0.0, 1.0]), (4, [7.0, 1.0])]


def test_normalised(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>").select(normalised(F.col("v")).alias("n"))
    assert [r.n for r in df.collect()] == [pytest.approx([0.6, 0.8]), None]


TEXTS = [(1, "The cup, the red cup"), (2, "a pen"), (3, "red pen and cup and more words here"), (4, ""), (5, None), (6, "RED")]


def bm25(texts, terms, k1=1.2, b=0.75):
    docs = {i: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()] for i, t in texts}
    mean = sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, words in docs.items():
        score = 0.0
        for t in terms:
            df, tf = sum(t in w for w in docs.values()), words.count(t)
            score += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / mean))
        if score:
            out[i] = score
    return sorted(out.items(), key=lambda x: (-x[1], x[0]))


def test_search_by_scan_and_by_index(spark, folder):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    want = bm25(TEXTS, ["cup", "red"])
    search.store_index(docs, folder)
    index, corpus = spark.read.parquet(f"{folder}/terms"), spark.read.parquet(f"{folder}/corpus")
    for got in (search.keyword_search(docs, "Red cup! cup"), search.search_index(index, corpus, "Red cup! cup")):
        got = got.collect()
        assert [r.doc_id for r in got] == [i for i, _ in want]
        assert [r.score for r in got] == pytest.approx([s for _, s in want])
    assert search.keyword_search(docs, "red", k=1).count() == 1
    assert search.keyword_search(docs, " !").count() == 0 == search.search_index(index, corpus, "").count()
    assert search.keyword_search(docs, "absent").count() == 0
    assert "In(term" in plan(search.search_index(index, corpus, "red cup"))


@pytest.fixture(scope="module")
def rated(spark):
    rng = random.Random(1)
    data = {(u, 100 * (u % 2) + rng.randrange(12)): rng.randrange(1, 5) for u in range(40) for _ in range(8)}
    return spark.createDataFrame([(u, i, n) for (u, i), n in data.items()], "user_id bigint, item_id bigint, purchase_count bigint")


def test_split_does_not_depend_on_partitions(rated):
    r = recommend.ratings(rated)
    assert r.schema.simpleString() == "struct<user_id:int,item_id:int,rating:float>"
    one, many = (recommend.with_split(r.repartition(n)) for n in (1, 7))
    assert rows(one) == rows(many)
    train, test = recommend.train_test(r)
    assert train.count() + test.count() == r.count() and 0.6 < train.count() / r.count() < 0.95


def test_als(rated):
    train, test = recommend.train_test(recommend.ratings(rated))
    model = recommend.fit_als(train, blocks=2)
    recs = recommend.recommend_all(model, ts("2024-01-31 00:00:00"), k=5).cache()
    assert recs.schema.simpleString() == (
        "struct<user_id:int,item_id:int,score:float,model_version:string,generated_at:timestamp_ntz>"
    )
    per_user = {}
    for r in recs.collect():
        per_user.setdefault(r.user_id, []).append(r)
        assert r.model_version == "als_v1"
    assert len(per_user) == 40 and all(len(v) == 5 for v in per_user.values())
    # users buy from one half of the items only; so should the recommendations be, on the whole
    own = sum(r.item_id // 100 == u % 2 for u, v in per_user.items() for r in v)
    assert own / 200 > 0.9
    quality = recommend.rmse(model, test).first()
    assert quality.rmse > 0 and 0 < quality.predictions <= test.count()
    metrics = recommend.ranking_metrics(recs, test, k=5).first()
    assert 0 <= metrics.precision_at_k <= 1 and metrics.users == test.select("user_id").distinct().count()


def test_als_blocks_go_by_ratings_and_cores(rated, monkeypatch):
    seen = []
    monkeypatch.setattr(recommend.ALS, "fit", lambda self, df: seen.append((self.getNumUserBlocks(), self.getNumItemBlocks())))
    spark, cores = rated.sparkSession, rated.sparkSession.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(20 * cores))
    try:
        recommend.fit_als(rated)
        monkeypatch.setattr(recommend, "BLOCK_RATINGS", 1)
        recommend.fit_als(rated)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [(cores, cores), (max(cores, rated.count()),) * 2]


def test_serving(spark):
    recs = spark.createDataFrame(
        [(1, 5, 0.5), (1, 4, 0.9), (1, 3, 0.5), (2, 9, 0.1), (999999, 123, 0.99)], "user_id int, item_id int, score float"
    )
    assert [r.item_id for r in recommend.recommend_for(recs, 1, 2).collect()] == [4, 3]
    assert recommend.recommend_for(recs, 999999).first().item_id == 123
    assert recommend.recommend_for(recs, 77).count() == 0
    wanted = spark.createDataFrame([(1,), (1,), (3,)], "user_id int")
    assert rows(recommend.recommend_for_users(recs, 2, wanted).select("user_id", "item_id")) == [(1, 3), (1, 4)]


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.7), (2, 1, 0.9)], "user_id int, item_id int, score float")
    held = spark.createDataFrame([(1, 2), (1, 9), (2, 5), (3, 1)], "user_id int, item_id int")
    row = recommend.ranking_metrics(recs, held, k=2).first()
    assert (row.precision_at_k, row.recall_at_k, row.users) == (pytest.approx(0.5 / 3), pytest.approx(0.5 / 3), 3)


def test_embedding_sees_few_texts_at_a_time(spark):
    def make():
        return lambda texts: np.array([[len(texts), 1.0]] * len(texts), dtype=np.float32)

    docs = spark.range(5000).select("id", F.lit("red cup").alias("t")).coalesce(1)
    before = {k: spark.conf.get(k) for k in BATCH_SETTINGS}
    try:
        for k in BATCH_SETTINGS:
            spark.conf.unset(k)
        made = vectors.embed(docs, "id", "t", make).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(made) == 5000 and max(r.embedding[0] for r in made) <= 1000


def test_words_of_unique_documents_are_counted_without_a_shuffle(spark):
    texts = [*TEXTS, (901, None), (902, " ! "), (903, "z a z A, z b"), (904, "one")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert docs.select("doc_id").distinct().count() == len(texts)
    local, grouped = search.index_terms(docs, unique=True), search.index_terms(docs)
    assert sorted(rows(local)) == sorted(rows(grouped)) and local.columns == grouped.columns
    assert "Exchange" not in plan(local) and "Exchange" in plan(grouped)
    assert local.schema["tf"].dataType == grouped.schema["tf"].dataType
