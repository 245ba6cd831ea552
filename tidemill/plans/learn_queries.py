"""Recommendation, vector and keyword search queries."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions import cosine_distance, similarity
from tidemill.operators import cells, factors, features, recommend, search
from tidemill.operators import similarity as vectors
from tidemill.plans.catalog import Shop, query
from tidemill.plans.frames import NOW
from tidemill.session import run_dir
from tidemill.sources import pending

SEARCH = "the wonder of things, and sounds"


def _features(shop: Shop) -> DataFrame:
    return features.user_item_features(shop.sales())


_RATED = """select cast(user_id as int) as user_id, cast(item_id as int) as item_id, cast(count(*) as float) as rating,
        cast('0x' || substr(md5(concat(user_id, '-', item_id, '-42')), 1, 8) as bigint) % 100 < 80 as is_train
    from silver_sales group by user_id, item_id"""


@query(_RATED, ("silver_sales",))
def als_ratings_split(shop: Shop) -> DataFrame:
    return recommend.with_split(recommend.ratings(_features(shop)))


def _model(shop: Shop):
    # Written, as training and testing read it several times.
    rated, path = recommend.ratings(_features(shop)), run_dir(shop.spark, "ratings")
    rated.write.parquet(path)
    train, test = recommend.train_test(shop.spark.read.schema(rated.schema).parquet(path))
    return recommend.fit_als(train), test


@query()
def als_topk(shop: Shop) -> DataFrame:
    model, _ = _model(shop)
    return recommend.recommend_all(model, NOW)


@query()
def als_rmse(shop: Shop) -> DataFrame:
    model, test = _model(shop)
    return recommend.rmse(model, test)


@query()
def als_ranking(shop: Shop) -> DataFrame:
    model, test = _model(shop)
    return recommend.ranking_metrics(recommend.recommend_all(model, NOW), test)


_COUNTED = "select user_id, item_id, cast(count(*) as double) as score from silver_sales group by all"


@query(
    f"""select user_id, item_id, score from (select *, row_number() over (partition by user_id order by score desc, item_id)
        as rn from ({_COUNTED})) where rn <= 10""",
    ("silver_sales",),
)
def recommend_for_users(shop: Shop) -> DataFrame:
    counted = _features(shop).select("user_id", "item_id", F.col("purchase_count").cast("double").alias("score"))
    return recommend.recommend_for_users(counted)


@query(
    f"""with r as ({_RATED}),
            shown as (select user_id, item_id from (select *, row_number() over (partition by user_id
                      order by rating desc, item_id) as rn from r where is_train) where rn <= 10),
            truth as (select distinct user_id, item_id % 100 as item_id from r where not is_train),
            s as (select distinct user_id, item_id % 100 as item_id from shown),
            h as (select t.user_id, count(*) as relevant, count(s.item_id) as hits
                  from truth t left join s on t.user_id = s.user_id and t.item_id = s.item_id group by all)
       select round(avg(hits / 10), 6) as precision_at_k, round(avg(hits / relevant), 6) as recall_at_k, count(*) as users
       from h""",
    ("silver_sales",),
)
def ranking_by_item_family(shop: Shop) -> DataFrame:
    """Precision and recall of "buy again" lists, with items told apart only by their family (last two digits)."""
    train, test = recommend.train_test(recommend.ratings(_features(shop)))
    family = (F.col("item_id") % 100).alias("item_id")
    again = recommend.recommend_for_users(train.withColumnRenamed("rating", "score"))
    again = again.select("user_id", family).distinct().withColumn("score", F.lit(1.0))
    metrics = recommend.ranking_metrics(again, test.select("user_id", family))
    return metrics.withColumns({c: F.round(c, 6) for c in ("precision_at_k", "recall_at_k")})


@query(
    """with u as (select vec_id, list_transform(embedding[1:10], lambda x: floor(16 * cast(x as double))) as v from embeddings),
            i as (select vec_id, list_transform(embedding[11:20], lambda x: floor(16 * cast(x as double)) * (1 + 40 // (1 + vec_id % 97))) as v
                  from embeddings)
       select user_id, item_id, score from (
           select u.vec_id as user_id, i.vec_id as item_id, list_dot_product(u.v, i.v) as score,
                  row_number() over (partition by u.vec_id order by list_dot_product(u.v, i.v) desc, i.vec_id) as rn
           from u, i) where rn <= 10"""
)
def recommend_by_factors(shop: Shop) -> DataFrame:
    """The best items of every user for factors taken from stored vectors, some items' much longer than the others'."""
    rows = shop.table("embeddings")
    whole = lambda x: F.floor(16 * x.cast("double")).cast("double")
    weight = 1 + F.floor(40 / (1 + F.col("vec_id") % 97))
    users = rows.select(F.col("vec_id").alias("id"), F.transform(F.slice("embedding", 1, 10), whole).alias("features"))
    items = rows.select(F.col("vec_id").alias("id"), F.transform(F.slice("embedding", 11, 10), lambda x: whole(x) * weight).alias("features"))
    found, _ = factors.top_items(users, items, first=64, most=512)
    return found


# Vectors --------------------------------------------------------------------------------------------------------------

_COS = "list_cosine_similarity(cast({a} as double[]), cast({b} as double[]))"


def _as_queries(shop: Shop) -> DataFrame:
    return shop.table("embeddings").select(F.col("vec_id").alias(vectors.QUERY), "embedding")


@query(
    f"""select query_id, vec_id, round(d, 6) as distance from (
            select q.vec_id as query_id, c.vec_id as vec_id, round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12) as d,
                   row_number() over (partition by q.vec_id
                       order by round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12), c.vec_id) as rn
            from embeddings q, embeddings c) where rn <= 5"""
)
def vector_topk(shop: Shop) -> DataFrame:
    """Every vector's nearest vectors in the whole table (itself first)."""
    found = vectors.similar(_as_queries(shop), shop.table("embeddings"))
    return found.withColumn("distance", F.round("distance", 6))


@query(
    f"""with c as (select label, list(m order by p) as centre from (
                select label, p, avg(cast(v as double)) as m
                from (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as p from embeddings)
                group by all) group by label)
        select label as query_id, vec_id, round(d, 6) as distance from (
            select c.label, e.vec_id, 1 - {_COS.format(a="c.centre", b="e.embedding")} as d,
                   row_number() over (partition by c.label order by 1 - {_COS.format(a="c.centre", b="e.embedding")}, e.vec_id) as rn
            from c, embeddings e) where rn <= 20"""
)
def vector_topk_of_centres(shop: Shop) -> DataFrame:
    """The vectors nearest to each label's mean vector: few queries over a corpus that is not shuffled."""
    rows = shop.table("embeddings")
    means = (
        rows.select("label", F.posexplode("embedding").alias("p", "v"))
        .groupBy("label", "p")
        .agg(F.avg(F.col("v").cast("double")).alias("m"))
    )
    centres = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("p", "m"))).alias("s"))
    queries = centres.select(F.col("label").alias(vectors.QUERY), F.col("s.m").alias("embedding"))
    return vectors.similar(queries, rows, k=20).withColumn("distance", F.round("distance", 6))


@query(
    f"""select a.vec_id, round(1 - {_COS.format(a="a.embedding", b="b.embedding")}, 6) as distance,
               round({_COS.format(a="a.embedding", b="b.embedding")}, 6) as similarity
        from embeddings a join embeddings b on b.vec_id = a.vec_id + 1"""
)
def vector_pairs_similarity(shop: Shop) -> DataFrame:
    """Each vector against the one stored after it."""
    rows = shop.table("embeddings")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    distance = cosine_distance(F.col("embedding"), F.col("other"))
    return rows.join(after, "vec_id").select(
        "vec_id", F.round(distance, 6).alias("distance"), F.round(similarity(distance), 6).alias("similarity")
    )


@query()
def vector_topk_approx(shop: Shop) -> DataFrame:
    return vectors.similar_approx(_as_queries(shop), shop.table("embeddings"))


@query(
    f"""select query_id, vec_id, round(d, 6) as distance from (
            select q.vec_id as query_id, c.vec_id as vec_id, round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12) as d,
                   row_number() over (partition by q.vec_id
                       order by round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12), c.vec_id) as rn
            from embeddings q, embeddings c) where rn <= 5"""
)
def vector_topk_cells(shop: Shop) -> DataFrame:
    """Exact search over a stored index: cells are met as long as their bounds allow a nearer vector."""
    root = run_dir(shop.spark, "cells")
    cells.build(shop.table("embeddings"), root)
    found, _ = cells.search(cells.Cells(shop.spark, root), _as_queries(shop), exact=True)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    f"""select query_id, vec_id, round(d, 6) as distance from (
            select q.vec_id as query_id, c.vec_id as vec_id, round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12) as d,
                   row_number() over (partition by q.vec_id
                       order by round(1 - {_COS.format(a="q.embedding", b="c.embedding")}, 12), c.vec_id) as rn
            from embeddings q, embeddings c) where rn <= 5"""
)
def vector_topk_all_cells(shop: Shop) -> DataFrame:
    """The approximate search with every cell probed."""
    root = run_dir(shop.spark, "cells")
    cells.build(shop.table("embeddings"), root)
    found, _ = cells.search(cells.Cells(shop.spark, root), _as_queries(shop), probe_groups=10_000, probes=1_000_000)
    return found.withColumn("distance", F.round("distance", 6))


@query()
def vector_topk_probed(shop: Shop) -> DataFrame:
    """The approximate search over the stored index with its default probes; its recall is measured in the tests."""
    root = run_dir(shop.spark, "cells")
    cells.build(shop.table("embeddings"), root)
    return cells.search(cells.Cells(shop.spark, root), _as_queries(shop))[0]


@query()
def embed_reviews(shop: Shop) -> DataFrame:
    """Vectors for the documents that have none yet: all of them, by hashed word weights."""
    docs = shop.table("documents")
    return vectors.embed_hashed(docs, "doc_id", "text")


def _hashed_words(size: int):
    """A stand-in for a sentence encoder: words hashed to signed positions, scaled to length 1."""

    def make():
        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), size), dtype=np.float32)
            for row, text in enumerate(texts):
                for word in text.lower().split():
                    h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                    out[row, h % size] += 1.0 if h >> 63 else -1.0
            sizes = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.maximum(sizes, 1e-12)

        return encode

    return make


@query("select doc_id, 384 as size, true as unit from documents where doc_id not in (select doc_id from labels)")
def embed_pending(shop: Shop) -> DataFrame:
    """Vectors by a pluggable encoder, for the documents without a finished row; the result tells their shape."""
    todo = pending(shop.table("documents"), shop.table("labels"), "doc_id")
    made = vectors.embed(todo, "doc_id", "text", _hashed_words(fixed.EMBEDDING_SIZE))
    length = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return made.select(
        "doc_id", F.size("embedding").alias("size"), ((F.abs(length - 1) < 1e-3) | (length == 0)).alias("unit")
    )


# Keyword search -------------------------------------------------------------------------------------------------------

_TERMS = search.query_terms(SEARCH)


def bm25_sql(documents: str) -> str:
    """The ten best of ``documents``, a table or subquery with doc_id and text."""
    return f"""
    with w as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') as w
               from {documents}),
         p as (select doc_id, len(w) as length, unnest(w) as term from w),
         t as (select doc_id, length, term, count(*) as tf from p
               where term in ({", ".join(f"'{t}'" for t in _TERMS)}) group by all),
         df as (select term, count(*) as df from t group by all),
         c as (select count(*) as n, avg(len(w)) as mean from w),
         s as (select doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * (1.2 + 1)
                   / (tf + 1.2 * (1 - 0.75 + 0.75 * length / mean))) as score
               from t join df using (term), c group by doc_id)
    select doc_id, round(score, 6) as score from s order by s.score desc, doc_id limit 10"""


_BM25 = bm25_sql("documents")


@query(_BM25)
def keyword_search(shop: Shop) -> DataFrame:
    found = search.keyword_search(shop.table("documents"), SEARCH)
    return found.withColumn("score", F.round("score", 6))


@query(_BM25)
def keyword_search_index(shop: Shop) -> DataFrame:
    """The same search over a stored index of terms."""
    root = run_dir(shop.spark, "index")
    search.store_index(shop.table("documents"), root)
    terms, corpus = (shop.spark.read.parquet(f"{root}/{part}") for part in ("terms", "corpus"))
    return search.search_index(terms, corpus, SEARCH).withColumn("score", F.round("score", 6))
