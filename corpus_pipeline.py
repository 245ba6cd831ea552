"""From raw documents to packed training sequences: language, toxicity, near duplicates, contamination, packing.

Every stage takes the documents its predecessor kept and returns documents with the same columns; the last one returns pieces of
sequences. A stage decides by its operator's result columns, which never meet the documents' own: rows are carried as one value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontaminate, jaccard, language, packing, toxicity
from tidemill.llm.common import settle, table, written


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """Rows whose judgement satisfies ``keep``, with their own columns and nothing else."""
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    return judge(carried).where(keep).select("_row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts that are null or have no letter go."""
    settle(spark)
    samples = language.learn(docs)
    return _kept(docs, lambda df: language.identify(df, samples, "_text"), F.col("lang_pred") != language.UNKNOWN)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest grade is not above 0."""
    settle(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _kept(docs, lambda df: toxicity.grade(df, model, "_text"), ~F.col("toxic"))


# Near copies: five words and a similarity of at least 0.8.
SHINGLE, SIMILAR = 5, jaccard.Threshold(80, 100)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones; documents without words are similar to none and stay.

    Rows go by a 64-bit hash of id and text, as ids may be missing or repeated; of the rows that go, and of rows that are there
    several times, only these hashes are joined with the documents, whose rows are carried as one value.
    """
    settle(spark)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64("doc_id", "text").alias("_key"), F.col("text").alias("_text"))
    found = jaccard.components(keyed, "_text", "_key", SHINGLE, SIMILAR).where(F.col("n_shingles") > 0)
    extra = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_key")).distinct()
    again = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_key")).count().where("count > 1").select("_key")
    once = keyed.join(extra.union(again), "_key", "left_anti").select("_row")
    first = keyed.join(again, "_key", "left_semi").dropDuplicates(["_key"]).select("_row")
    return once.union(first).select("_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    settle(spark)
    items = table(spark, sf_dir, "benchmark")
    return _kept(docs, lambda df: decontaminate.contamination(df, items, "_text"), ~F.col("contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]
# Trained models and tokenizers have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each other stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
CHECKS: dict[str, str] = {}
