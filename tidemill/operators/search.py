"""Keyword search with BM25, by scan or over a stored index of terms.

Query words are few and known when the plan is built, so a scan needs no explode, join or shuffle of texts: one pass over
them keeps the word counts of the documents that match, as a small table in the shared folder, and observes the corpus
statistics on the way. Scores then come from that table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions import tokens
from tidemill.session import run_dir


def query_terms(query: str) -> list[str]:
    """Distinct words of a search text, cut and lower-cased as texts are."""
    return sorted({w for w in re.split(r"[\W_]+", query.lower()) if w})


def _occurrences(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda word: word == F.lit(term)))


def _idf(n: Column, df: Column) -> Column:
    return F.ln(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def _term_score(tf: Column, idf: Column, length: Column, mean: Column, k1: float, b: float) -> Column:
    return idf * tf * (k1 + 1.0) / (tf + F.lit(k1) * (1.0 - b + F.lit(b) * length / mean))


def keyword_search(
    docs: DataFrame,
    query: str,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
) -> DataFrame:
    """The k best documents for any of the query's words, as (key, score)."""
    terms = query_terms(query)
    if not terms:
        return docs.select(key, F.lit(0.0).alias("score")).limit(0)
    spark, seen, folder = docs.sparkSession, Observation(), run_dir(docs.sparkSession, "search")
    cut = docs.select(key, tokens(F.col(text)).alias("w"))
    # Cut down to the query's words first: the counts per word then look at a few elements, not at the whole text.
    found = cut.select(key, F.size("w").alias("length"), F.filter("w", lambda word: word.isin(terms)).alias("hits"))
    words = found.select(key, "length", *[_occurrences("hits", t).alias(f"tf{i}") for i, t in enumerate(terms)])
    observed = words.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.sum("length").alias("length"),
        *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
    )
    observed.where(F.greatest(*[F.col(f"tf{i}") for i in range(len(terms))], F.lit(0)) > 0).write.parquet(folder)
    stats = seen.get
    n, mean = F.lit(float(stats["n"])), F.lit((stats["length"] or 0) / max(stats["n"], 1))
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = _idf(n, F.lit(stats[f"df{i}"]))
        score = score + _term_score(F.col(f"tf{i}"), idf, F.col("length"), mean, k1, b)
    schema = words.schema
    hits = spark.read.schema(schema).parquet(folder)
    return hits.select(key, score.alias("score")).orderBy(F.col("score").desc(), key).limit(k)


def index_terms(docs: DataFrame, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = (), unique: bool = False) -> DataFrame:
    """One row per document and distinct word: (term, key, length, tf), and the columns ``also`` of the document.

    A word found in every document costs one row per document. Of ``unique`` keys a document's words are counted where it lies, as runs
    of its sorted words, and nothing is shuffled; else rows of one key and length are counted as one.
    """
    words = docs.select(key, *also, tokens(F.col(text)).alias("w")).select(key, *also, F.size("w").alias("length"), (F.sort_array("w") if unique else F.col("w")).alias("w"))
    if not unique:
        each = words.select(key, *also, "length", F.explode("w").alias("term"))
        return each.groupBy("term", key, *also, "length").agg(F.count(F.lit(1)).alias("tf"))
    ends = F.filter(F.sequence(F.lit(1), F.col("length")), lambda i: (i == F.col("length")) | (F.get("w", i) != F.get("w", i - 1)))
    runs = words.where("length > 0").select(key, *also, "length", "w", ends.alias("ends"))
    begins = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    counted = F.zip_with(begins, "ends", lambda at, end: F.struct(F.get("w", at).alias("term"), (end - at).cast("long").alias("tf")))
    each = runs.select(key, *also, "length", F.explode(counted).alias("run"))
    return each.select("run.term", key, *also, "length", "run.tf")


def store_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the index under a path, gathered and sorted by term so that a search skips all but a few row groups.

    The rebalance hint splits the rows of a very common word over several files.
    """
    unique = docs.groupBy(key).count().where("count > 1").isEmpty()
    index = index_terms(docs, key, text, unique=unique).hint("rebalance", "term").sortWithinPartitions("term", key)
    index.write.mode("overwrite").parquet(f"{path}/terms")
    corpus_size(docs, text).write.mode("overwrite").parquet(f"{path}/corpus")


def corpus_size(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row (n, mean): documents and their mean length in words, stored next to the index."""
    return docs.select(F.size(tokens(F.col(text))).alias("length")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("length").alias("mean")
    )


def search_index(
    index: DataFrame,
    corpus: DataFrame,
    query: str,
    k: int = 10,
    key: str = "doc_id",
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
) -> DataFrame:
    """As ``keyword_search`` over a stored index; only the row groups of the query's words are read."""
    terms = query_terms(query)
    if not terms:
        return index.select(key, F.lit(0.0).alias("score")).limit(0)
    hits = index.where(F.col("term").isin(terms))
    wide = hits.groupBy(key, "length").agg(
        *[F.max(F.when(F.col("term") == t, F.col("tf"))).alias(f"tf{i}") for i, t in enumerate(terms)]
    )
    found = hits.agg(*[F.count_if(F.col("term") == t).alias(f"df{i}") for i, t in enumerate(terms)])
    scored = wide.withColumns(
        {"s": found.select(F.struct("*").alias("s")).scalar(), "c": corpus.select(F.struct("n", "mean").alias("c")).scalar()}
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf = F.coalesce(F.col(f"tf{i}"), F.lit(0))
        idf = _idf(F.col("c.n"), F.col(f"s.df{i}"))
        score = score + _term_score(tf, idf, F.col("length"), F.col("c.mean"), k1, b)
    return scored.select(key, score.alias("score")).orderBy(F.col("score").desc(), key).limit(k)
