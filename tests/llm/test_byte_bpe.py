"""Byte-level BPE against the public library, and the perfect hash and the merging against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from helpers import plan
from tidemill.llm import byte_bpe
from tidemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "\n\n  \t x  ", "It's we'll DON'T 'quoted' 's", "x" * 4000, "ab" * 3000 + " " * 500, "a\x00b \x00", "<|endoftext|> x", "日本語テキスト 한국어 ελληνικά",
    "12,345.67 ½² !!!", "\x1c\x1d\x85 　wide", "é é 🙂🙂‍🔥 ﻿", "tab\tline\r\n end ",
]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(byte_bpe.default_path())


@pytest.fixture(scope="module")
def library(ranks):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(own.encode_ordinary(text or ""), "<u4").tobytes()


def test_perfect_hash_is_minimal_and_exact(ranks):
    table = byte_bpe.PerfectHash.of(ranks)
    assert len(table.keys) == len(ranks) and sorted(table.values.tolist()) == sorted(ranks.values())
    keys = list(ranks)
    assert [table.keys[s] for s in table.slots(keys).tolist()] == keys
    assert all(table.find(k) == r for k, r in ranks.items())
    assert all(table.find(k + b"\xff\xfe") == -1 for k in keys[:2000])
    for n in (1, 2, 3, 5, 9):
        few = byte_bpe.PerfectHash.of({b"%d" % i: i for i in range(n)})
        assert [few.find(b"%d" % i) for i in range(n + 1)] == [*range(n), -1]


def plain_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [bytes([b]) for b in piece]
    while True:
        joined = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joined:
            return [ranks[p] for p in parts]
        i = min(joined)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merging_takes_the_least_rank_and_the_leftmost(ranks):
    rng, single = random.Random(5), [ranks[bytes([b])] for b in range(256)]
    for n in (1, 2, 3, 8, 20, 200):
        for _ in range(40):
            piece = bytes(rng.choices(b"aeinrst th\xc3\xa9", k=n))
            assert byte_bpe.merge(piece, lambda k: ranks.get(k, -1), single) == plain_merge(piece, ranks)


def test_encoder_agrees_with_the_library(spark, ranks, library, monkeypatch):
    rng = random.Random(3)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    texts += ["".join(rng.choices("abzéÖß'.,!-\n \t<>|s1日", k=80)) for _ in range(400)]
    table = byte_bpe.PerfectHash.of(ranks)
    whole = byte_bpe.Encoder(table, public_tokenizers.PATTERN)
    forgetful = byte_bpe.Encoder(table, public_tokenizers.PATTERN, limit=5)
    for t in texts:
        assert whole(t) == forgetful(t) == library(t), t
    assert max(map(len, whole.known)) <= byte_bpe.LONGEST_KEPT
    monkeypatch.setattr(byte_bpe.stretches, "__defaults__", (7,))
    for t in texts:
        assert whole(t) == library(t), t


def test_unknown_words_of_many_texts_are_merged_together(ranks, library, monkeypatch):
    table, rng, merge, long = byte_bpe.PerfectHash.of(ranks), random.Random(11), byte_bpe.merge, []
    monkeypatch.setattr(byte_bpe, "merge", lambda piece, *more: long.append(len(piece)) or merge(piece, *more))
    words = ["".join(rng.choices("aeionrstlzq\u00e9\u4e16\U0001f600", k=rng.randint(1, 30))) for _ in range(3000)] + ["ab" * 500, "a" * 64, "a" * 65]
    texts = [None, "", *[" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(400)], " ".join(words)]
    for gather, rows, stretch in ((1_000_000, 8192, 200_000), (50, 7, 20)):
        for name, value in (("GATHER", gather), ("ROWS", rows)):
            monkeypatch.setattr(byte_bpe, name, value)
        monkeypatch.setattr(byte_bpe.stretches, "__defaults__", (stretch,))
        got = list(byte_bpe.Encoder(table, public_tokenizers.PATTERN).many(texts))
        assert got == [library(t or "") for t in texts]
    assert long and min(long) > byte_bpe.SHORT  # each unknown word before


def test_encode_and_decode_rows(spark, library):
    rows = [(i, t, b"clash", "clash", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], None, None, None), (None, "no id", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary, decoded string, n_tokens int").repartition(3)
    codec = byte_bpe.Codec(spark)
    done = byte_bpe.decode(byte_bpe.encode(df, codec), codec)
    assert done.columns == ["doc_id", "ids", "decoded"]
    assert plan(done).count("encoded(") == 1
    got = sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in done.collect()), key=repr)
    assert got == sorted(((r[0], library(r[1]), (r[1] or "").encode()) for r in rows), key=repr)
    assert byte_bpe.encode(df.limit(0), codec).count() == 0
    lost = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bytes(byte_bpe.decode(lost, codec).first().decoded) == b""
    with pytest.raises(ValueError, match="no token"):
        byte_bpe.bytes_of(np.array([60_000], "<u4").tobytes(), [b"x"])


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
