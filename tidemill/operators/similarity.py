"""Vector search: embedding texts, exact nearest neighbours, and approximate ones by cells.

Exact search compares every query with every vector; that is its definition. What Spark decides is where: vectors are
dealt to tasks in blocks, each task multiplies matrices and keeps only its k best per query, and those are merged per
query. No pair is ever a row.

Distances are cosine distances, rounded to 12 digits so that equal vectors tie, and ties go to the smaller key. Vectors
that are NULL or all zero have no direction and are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions import tokens
from tidemill.operators.dedup import top_per_key
from tidemill.session import small_batches

QUERY, DISTANCE, RANK = "query_id", "distance", "rank"
BROADCAST_QUERIES = 512
CORPUS_BLOCK, QUERY_BLOCK = 20_000, 2_000

Encoder = Callable[[list[str]], np.ndarray]


def embed(df: DataFrame, key: str, text: str, make_encoder: Callable[[], Encoder]) -> DataFrame:
    """(key, embedding) by any encoder; it is made once per task and then sees the texts in small batches."""
    small_batches(df.sparkSession)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for batch in batches:
            vectors = encoder(batch[text].fillna("").tolist())
            yield pd.DataFrame({key: batch[key], "embedding": list(vectors)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInPandas(encode, f"{key} {kind}, embedding array<float>")


def embed_hashed(df: DataFrame, key: str, text: str, size: int = fixed.EMBEDDING_SIZE, corpus: DataFrame | None = None) -> DataFrame:
    """(key, embedding) by hashed word counts, weighted by rarity in ``corpus`` and scaled to length 1; JVM only."""
    count = HashingTF(numFeatures=size, inputCol="words", outputCol="tf")

    def counted(rows: DataFrame, *columns: str) -> DataFrame:
        return count.transform(rows.select(*columns, tokens(F.col(text)).alias("words")))

    rarity = IDF(inputCol="tf", outputCol="tfidf").fit(counted(corpus if corpus is not None else df))
    scaled = Normalizer(inputCol="tfidf", outputCol="unit").transform(rarity.transform(counted(df, key)))
    return scaled.select(key, vector_to_array("unit", "float32").alias("embedding"))


def _kernel(k: int):
    """Functions that run inside tasks; nested, so that they travel with the job and workers need no extra package."""

    def unit(keys, vectors):
        pairs = [(i, v) for i, v in zip(keys, vectors) if v is not None]
        if not pairs:
            return np.array([]), np.zeros((0, 0))
        ids = np.asarray([i for i, _ in pairs])
        matrix = np.stack([np.asarray(v, dtype=np.float64) for _, v in pairs])
        sizes = np.sqrt((matrix * matrix).sum(axis=1))
        good = np.isfinite(sizes) & (sizes > 0)
        return ids[good], matrix[good] / sizes[good, None]

    def best(query_ids, queries, ids, vectors) -> pd.DataFrame:
        found_q, found_i, found_d = [], [], []
        few = min(k, len(ids))
        for begin in range(0, len(query_ids) if few else 0, 256):
            distances = np.round(1.0 - queries[begin:begin + 256] @ vectors.T, 12)
            limits = np.partition(distances, few - 1, axis=1)[:, few - 1]
            for row, (distance, limit) in enumerate(zip(distances, limits)):
                near = np.flatnonzero(distance <= limit)
                near = near[np.lexsort((ids[near], distance[near]))[:k]]
                found_q.append(np.repeat(query_ids[begin + row], len(near)))
                found_i.append(ids[near])
                found_d.append(distance[near])
        if not found_q:
            return pd.DataFrame({"q": [], "i": [], "d": []})
        return pd.DataFrame({"q": np.concatenate(found_q), "i": np.concatenate(found_i), "d": np.concatenate(found_d)})

    return unit, best


def _ranked(found: DataFrame, key: str, k: int) -> DataFrame:
    ranked = top_per_key(found, [QUERY], [F.col(DISTANCE).asc(), F.col(key).asc()], k)
    return ranked.select(QUERY, key, DISTANCE)


def _result_schema(queries: DataFrame, corpus: DataFrame, key: str) -> str:
    query_type = queries.schema[QUERY].dataType.simpleString()
    return f"{QUERY} {query_type}, {key} {corpus.schema[key].dataType.simpleString()}, {DISTANCE} double"


def _scan(rows: list, corpus: DataFrame, k: int, key: str, vector: str, schema: str) -> DataFrame:
    """The corpus scanned once where it lies, with the few queries shipped to every task."""
    unit, best = _kernel(k)
    query_ids, matrix = unit([r[0] for r in rows], [r[1] for r in rows])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            ids, vectors = unit(batch[key], batch[vector])
            found = best(query_ids, matrix, ids, vectors)
            held = found if held is None else pd.concat([held, found])
            held = held.sort_values(["q", "d", "i"]).groupby("q", sort=False).head(k)
        if held is not None and len(held):
            yield held.rename(columns={"q": QUERY, "i": key, "d": DISTANCE})

    return corpus.select(key, vector).mapInPandas(search, schema)


def _deal(queries: DataFrame, corpus: DataFrame, k: int, key: str, vector: str, schema: str) -> DataFrame:
    """Compare queries with the vectors of their cells, block against block.

    Both sides carry ``cell`` and into how many blocks its vectors (``c_blocks``) and its queries (``q_blocks``) are cut.
    Rows are dealt to blocks by a hash of their key, so neither a crowded cell nor many copies of one vector make a large
    task. Every query block of a cell meets every vector block of it once.
    """
    unit, best = _kernel(k)

    def spread(rows: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(rows.columns[0]), F.col(own_blocks)).cast("int").alias(own)
        theirs = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other)
        return rows.select(*rows.columns[:2], "cell", mine, theirs)

    sizes = ["cell", "c_blocks", "q_blocks"]
    vectors = spread(corpus.select(key, vector, *sizes), "cb", "c_blocks", "qb", "q_blocks")
    asked = spread(queries.select(QUERY, F.col(vector).alias("__query"), *sizes), "qb", "q_blocks", "cb", "c_blocks")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        query_ids, matrix = unit(left[QUERY], left["__query"])
        ids, rows = unit(right[key], right[vector])
        return best(query_ids, matrix, ids, rows).rename(columns={"q": QUERY, "i": key, "d": DISTANCE})

    where = ["cell", "cb", "qb"]
    return asked.groupBy(*where).cogroup(vectors.groupBy(*where)).applyInPandas(search, schema)


def similar(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = fixed.SIMILAR_DEFAULT,
    key: str = "vec_id",
    vector: str = "embedding",
    corpus_block: int = CORPUS_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k nearest vectors of ``corpus`` for each row (query_id, vector) of ``queries``: (query_id, key, distance).

    Queries without an id are left out. Up to ``BROADCAST_QUERIES`` queries - counted, not assumed - are shipped to the corpus, which then is not shuffled.
    More are dealt out in blocks.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    queries = queries.where(F.col(QUERY).isNotNull())
    schema = _result_schema(queries, corpus, key)
    few = queries.select(QUERY, vector).limit(BROADCAST_QUERIES + 1).collect()
    if len(few) <= BROADCAST_QUERIES:
        return _ranked(_scan(few, corpus, k, key, vector, schema), key, k)
    blocks = {
        "cell": F.lit(0),
        "c_blocks": F.lit(max(1, math.ceil(corpus.count() / corpus_block))),
        "q_blocks": F.lit(max(1, math.ceil(queries.count() / query_block))),
    }
    found = _deal(queries.withColumns(blocks), corpus.withColumns(blocks), k, key, vector, schema)
    return _ranked(found, key, k)


def similar_approx(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = fixed.SIMILAR_DEFAULT,
    lists: int = 16,
    probes: int = 4,
    key: str = "vec_id",
    vector: str = "embedding",
    seed: int = 42,
    iterations: int = 5,
    corpus_block: int = CORPUS_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """As ``similar``, but each query only meets the vectors of its ``probes`` nearest of ``lists`` cells.

    Cells are k-means clusters of the directions. With ``probes = lists`` the result is exact.
    """
    schema = _result_schema(queries, corpus, key)
    direction = Normalizer(inputCol="raw", outputCol="unit")
    usable = corpus.where(F.exists(F.col(vector), lambda x: x != 0))
    trained = direction.transform(usable.select(array_to_vector(F.col(vector).cast("array<double>")).alias("raw")))
    model = KMeans(k=lists, seed=seed, maxIter=iterations, featuresCol="unit").fit(trained)
    centres = np.asarray(model.clusterCenters())
    centres = centres / np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-300)

    def nearest(n: int):
        @F.pandas_udf("array<int>")
        def cells(vectors: pd.Series) -> pd.Series:
            rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
            return pd.Series(list(np.argsort(-(rows @ centres.T), axis=1, kind="stable")[:, :n].astype(np.int32)))

        return cells

    asked = queries.where(F.exists(F.col(vector), lambda x: x != 0)).select(
        QUERY, vector, F.explode(nearest(probes)(vector)).alias("cell")
    )
    dealt = usable.select(key, vector, F.get(nearest(1)(vector), F.lit(0)).alias("cell"))

    def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
        return rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    # At most one row per cell, so Spark broadcasts it.
    sizes = blocks(dealt, "c_blocks", corpus_block).join(blocks(asked, "q_blocks", query_block), "cell")
    return _ranked(_deal(asked.join(sizes, "cell"), dealt.join(sizes, "cell"), k, key, vector, schema), key, k)
