"""The pipeline against a plain version of its stages, and the registered corpus queries."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from test_search_join import contaminated, groups
from tidemill.llm import language, queries, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit(7))
    extra = spark.createDataFrame([(9001, None, "en"), (9002, "123", None), (9003, "und der die das", "de"), (9003, "und der die das", "de")], "doc_id long, text string, lang string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)

    first = corpus_pipeline.identify_language(spark, docs, SF)
    assert first.columns == docs.columns
    assert rows(first) == sorted((r for r in map(tuple, docs.collect()) if r[1] and any(c.isalpha() for c in r[1])), key=repr)
    second = corpus_pipeline.drop_toxic(spark, first, SF)
    bad = {r.text for r in toxicity.grade(first, toxicity.train(first, labels)).where("toxic").collect()}
    assert second.columns == docs.columns and rows(second) == sorted((r for r in map(tuple, first.collect()) if r[1] not in bad), key=repr)
    third = corpus_pipeline.drop_near_copies(spark, second, SF)
    kept, given = rows(third), rows(second)
    number = {(r[0], r[1]): i for i, r in enumerate(given)}
    component = {i: c for i, _, c in groups([(number[r[0], r[1]], r[1]) for r in given], 5, 80)}
    assert third.columns == docs.columns and set(kept) <= set(given)
    assert sorted(component[number[r[0], r[1]]] for r in kept) == sorted(set(component.values()))
    fourth = corpus_pipeline.drop_contaminated(spark, third, SF)
    hit = {r[0] for r in contaminated([(r[0], r[1]) for r in kept], [tuple(r) for r in items.select("item_id", "text").collect()]) if r[-1]}
    assert hit and rows(fourth) == [r for r in kept if r[0] not in hit]
    pieces = corpus_pipeline.pack(spark, fourth, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r[0] for r in rows(fourth)}


def test_wordless_documents_stay_apart(spark):
    docs = spark.createDataFrame([(None, ""), (None, ""), (1, None), (2, None), (3, "a b c d e"), (4, "A b c d e")], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert len(kept) == 5 and sum(r.text is not None and "b" in r.text for r in kept) == 1


def test_clashing_columns_and_empty_tables(spark):
    clash = "doc_id long, text string, _key string, `a.b` int, _row int, _text string, n_shingles int, component_id string, lang string, _found int, severity int"
    more = ("kept", 5, 6, "t", 7, "c", "en", 8, 9)
    docs = spark.createDataFrame([(1, "one two three four five six", *more), (2, "one two three four five six", *more), (3, "other words are in this", *more)], clash)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        assert {tuple(r)[2:] for r in kept.collect()} <= {more}
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.drop_near_copies(spark, docs, SF).count() == 2
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0


def test_run_and_registered(spark):
    ten = sorted(n for n in entry.queries() if n.startswith("op"))
    assert [int(n[2:].split("_")[0]) for n in sorted(ten, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][-1] == "pack" and len(corpus_pipeline.STAGES) == 5
    assert entry.queries()["pipeline"](spark, SF).count() > 100


def test_top_k_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = {tuple(r) for r in queries.op1_topk(spark, SF).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == set(db.execute(queries.CHECKS["op1_topk"]).fetchall())
    assert language.UNKNOWN == "und"


def test_workers_give_memory_back_after_each_frame(monkeypatch):
    """Near copies and packing ran at 3000 MB of an executor, of which idle workers held what earlier frames had freed."""
    import pandas as pd

    from tidemill.llm import common, jaccard

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    frames = [pd.DataFrame({"doc_id": ["1", None], "text": ["a b c d e f", None]})] * 3
    plain, lean = (list(f(iter(frames))) for f in (jaccard._signatures(5), common.lean(jaccard._signatures(5))))
    assert len(given) == len(plain) + 1
    plain, lean = ([f[["doc_id", "n", "key"]].astype(object).values.tolist() for f in frames] for frames in (plain, lean))
    assert str(plain) == str(lean)
    monkeypatch.undo()
    common.give_back()
