"""Tokenizing, flat token files, packing and sharding."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import plan
from tidemill.llm import packing, shards, token_counts, tokens

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, start string, shard string"
ODD = [
    "", None, " \n\t ", "It's we'll DON'T", "ÀÉÎ straße ÑANDÚ", "x" * 5000, "a\x00b \x00", "<|endoftext|> <|startoftext|>x", "é İI ΣΑΣ", "12,345.6!!",
    "tab\tline\x1cfile\x1f", "日本語 текст ελ", " nb em", "'s 't 'll", "a.b,c;d", "🙂🙂 ok", "\"quoted\" (x) [y]", "½ ² ª º µ",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_cached_tokenizer_agrees(spark, plain):
    ours = tokens.WordTokenizer(tokens.default_path(), limit=500)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()] + ODD
    rng = random.Random(2)
    texts += ["".join(rng.choices("abzéÖß'.,!-\n <>|s1́", k=60)) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == plain(t), t


def docs(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(ODD)] + [(3, ODD[3], "", ""), (None, "no id", "", ""), (77, "word " * 9000, "", "")]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


def test_token_counts(spark, plain):
    rows, df = docs(spark)
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(df).collect()), key=repr)
    assert got == sorted(((r[0], len(plain(r[1]))) for r in rows), key=repr)
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 16, 1000])
def test_flat_files(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    want = []
    for name in ("a", "b", "c"):
        lengths = rng.integers(0, 9, 30).tolist()
        ids = np.concatenate([np.append(rng.integers(0, 100, n), 999) for n in lengths] + ([np.array([5, 6])] if name == "c" else []))
        (tmp_path / f"{name}.bin").write_bytes(ids.astype("<u2").tobytes())
        want += [(f"{name}.bin", n, True) for n in lengths] + ([("c.bin", 2, False)] if name == "c" else [])
    got = token_counts.scan_files(spark, str(tmp_path), 999, block).collect()
    assert sorted((os.path.basename(r.file), r.n_tokens, r.ended) for r in got) == sorted(want)


def test_blocks_cut_documents(spark, plain):
    rows, df = docs(spark)
    blocks = token_counts.flatten(df, block_ids=7)
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.stitch(token_counts.scan(blocks)).collect()), key=repr)
    assert got == sorted(((r[0], len(plain(r[1]))) for r in rows), key=repr)


def check_packed(got, rows, plain, capacity=2048):
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(np.array(plain(t) + [1], "<u4"))
    for d, all_ids in want.items():
        ids, copies = all_ids[0], len(all_ids)
        spans = sorted((r.start, r.length) for r in by_doc[d])
        assert sum(n for _, n in spans) == copies * len(ids) and all(r.doc_tokens == len(ids) for r in by_doc[d])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in by_doc[d])
        assert {i for s, n in spans for i in range(s, s + n)} == set(range(len(ids)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    return [sum(r.length for r in p) for p in by_sequence.values()]


def test_packing(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)  # several rounds
    rows, df = docs(spark)
    lengths = check_packed(packing.pack(df.repartition(7)).collect(), [r[:2] for r in rows], plain)
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths) < 0.05 * sum(lengths)
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_packing_pads_little(spark, plain):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    lengths = check_packed(packing.pack(df).collect(), [(r.doc_id, r.text) for r in df.collect()], plain)
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths) < 0.02 * sum(lengths)


def test_cuts_cover_and_fit():
    for n in range(1, 5000):
        cut = packing.cuts(n)
        assert sum(x for x, _ in cut) == n and all(0 < x <= 2048 // k for x, k in cut)


@pytest.mark.parametrize("n", [40, 7, 1])
def test_shards(spark, n):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = shards.shard(df, n).collect()
    text = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    by = {}
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id]))
        by.setdefault(r.shard, []).append(r)
    assert set(by) == set(range(n))
    assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in by.values())
    total, longest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in g) - total / n) <= longest for g in by.values())


def test_shards_of_odd_rows(spark):
    rows = [(i, "same text", None, "s") for i in range(300)] + [(5, "same text", None, "s")] * 200 + [(None, None, None, None), (1, "", None, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("size", F.lit("clash"))
    got = shards.shard(df, 8).collect()
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert len(got) == len(rows) and max(sizes) - min(sizes) <= 60
    assert shards.shard(df.limit(0), 8).count() == 0
    assert len({r.shard for r in shards.shard(df, target_bytes=5000).collect()}) == 3


def test_shards_run_no_python(spark):
    assert "Python" not in plan(shards.shard(spark.read.parquet(f"{SF}/documents.parquet"), 4))
