"""The search index that follows a change stream, against a search over the documents as they are."""

from __future__ import annotations

import os
import random

import pytest

from helpers import plan, rows
from test_streams import write_lines
from tidemill.operators import search
from tidemill.schemas import declared
from tidemill.sources import read_event_stream
from tidemill.streaming import search as live

CHANGE = declared("id bigint, op string, seq bigint, text string")
WORDS = "sun moon star sea wind rain".split()


def change(key, seq, text, op="u"):
    return {"id": key, "seq": seq, "op": op, "text": text}


class Index:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.root, self.n = spark, folder, f"{folder}/index", 0
        self.state = {}  # key -> (seq, text or None)

    def take(self, changes, checkpoint="ck"):
        write_lines(f"{self.folder}/in-{checkpoint}", f"{self.n}.json", changes)
        self.n += 1
        self.run(checkpoint)
        newest = {}
        for c in changes:
            if c["id"] not in newest or newest[c["id"]][0] < c["seq"]:
                newest[c["id"]] = (c["seq"], None if c["op"] == "d" else c["text"] or "")
        for key, (seq, text) in newest.items():
            if key not in self.state or seq > self.state[key][0]:
                self.state[key] = (seq, text)

    def run(self, checkpoint="ck"):
        stream = read_event_stream(self.spark, f"{self.folder}/in-{checkpoint}", CHANGE, files_per_batch=1)
        live.index_stream(stream, self.root, f"{self.folder}/{checkpoint}", "id", "text")

    def check(self, *queries):
        docs = [(k, t) for k, (_, t) in self.state.items() if t is not None]
        table = self.spark.createDataFrame(docs, "id bigint, text string")
        for q in queries or ("sun", "moon wind", "nothing"):
            rounded = lambda df: [(r.id, round(r.score, 9)) for r in df.collect()]
            assert rounded(live.search(self.spark, self.root, q, key="id")) == rounded(search.keyword_search(table, q, key="id"))
        known = live.documents(self.spark, self.root, "id")
        assert rows(known.select("id", "seq")) == sorted(((k, s) for k, (s, t) in self.state.items() if t is not None), key=repr)

    def files(self):
        return {os.path.join(d, f) for d, _, names in os.walk(self.root) for f in names if f.endswith(".parquet")}


def test_changes_are_found_and_old_segments_stay(spark, folder):
    with pytest.raises(FileNotFoundError):
        live.search(spark, f"{folder}/none", "sun")
    index = Index(spark, folder)
    index.take([change(1, 1, "sun sun moon", "c"), change(2, 2, "moon wind", "c"), change(3, 3, "rain", "c"), change(4, 4, None, "c")])
    index.check()
    before = {f: os.stat(f).st_mtime_ns for f in index.files()}
    index.take([change(1, 5, "wind wind sea"), change(3, 6, None, "d"), change(2, 1, "sun late"), change(5, 7, "sun", "c"), change(5, 8, "sun star")])
    index.check()
    assert before == {f: os.stat(f).st_mtime_ns for f in before}
    # Late for a deleted document, a delete of an unknown one, and a sequence that is there already.
    index.take([change(3, 4, "sun rain"), change(9, 9, None, "d"), change(1, 5, "moon again")])
    index.check()
    index.take([change(9, 8, "late sun"), change(3, 20, "sun is back", "c")])
    index.check()
    made = live.merge_segments(spark, index.root, everything=True)
    assert len(made) == 1
    index.check()
    live.expire(spark, index.root)
    index.check()
    assert spark.read.parquet(f"{index.root}/segment-m-0/dead").isEmpty()
    assert spark.read.parquet(f"{index.root}/segment-m-0/versions").count() == len(index.state)
    # The progress is lost: everything comes again and adds nothing.
    os.rename(f"{folder}/ck", f"{folder}/lost")
    index.run()
    index.check()


def test_random_changes_and_levels(spark, folder):
    rng, index = random.Random(8), Index(spark, folder)
    for batch in range(5):
        changes = [
            change(rng.randint(1, 12), rng.randint(1, 60) * 10 + batch, " ".join(rng.choices(WORDS, k=rng.randint(0, 6))), rng.choice("ucud"))
            for _ in range(6)
        ]
        index.take(list({(c["id"], c["seq"]): c for c in changes}.values()))
        live.merge_segments(spark, index.root, fan_in=2)
    index.check()
    segments = live.Segments(spark, index.root)
    assert [m.level for m in segments.merged] == [2] and len(segments.parts) == 1
    assert segments.corpus().first().n == sum(t is not None for _, t in index.state.values())


def test_a_search_reads_its_words_only(spark, folder):
    index = Index(spark, folder)
    index.take([change(1, 1, "sun sea", "c")])
    text = plan(live.search(spark, index.root, "sun sea"))
    assert "In(term, [sea,sun])" in text and "ReadSchema: struct<term:string,key:bigint,seq:bigint,length:int,tf:bigint>" in text


def test_rows_without_key_or_sequence(spark, folder):
    index = Index(spark, folder)
    write_lines(f"{folder}/in-ck", "a.json", [{"id": None, "op": "c", "seq": 1, "text": "sun"}, {"id": 1, "op": "c", "seq": None, "text": "sun"}])
    index.run()
    assert [r.id for r in live.search(spark, index.root, "sun", key="id").collect()] == [1]
    index.take([change(1, -5, "moon")])
    index.state = {1: (-5, "moon")}
    index.check()


def test_a_segment_counts_words_where_the_texts_lie(spark, folder, monkeypatch):
    """Words were shuffled once more to be counted, and texts cut into words a third time for the statistics."""
    counted, told, terms, stats = [], [], live.index_terms, live._stats
    monkeypatch.setattr(live, "index_terms", lambda *a, **b: counted.append(b.get("unique")) or terms(*a, **b))
    monkeypatch.setattr(live, "_stats", lambda added, removed: told.append("split" in plan(added)) or stats(added, removed))
    index = Index(spark, folder)
    index.take([change(1, 1, "sun sun moon"), change(1, 2, "sea sun sea"), change(2, 1, "moon wind"), change(3, 1, None)])
    assert counted == [True] and told == [False]
    index.check("sun", "sea moon")
