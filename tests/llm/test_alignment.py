"""Cross-tokenizer alignment against a plain version over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemill.llm import alignment
from tidemill.llm.queries import QUERIES
from tidemill.llm.tokens import _byte_letters

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "  ", "a", " lead", "trail ", "two  spaces   three", "tab\tand\nline \n x", "naïve café — dash", "日本語テキスト mixed 한국어", "🙂🙂‍🔥 ok",
    "x▁y here", "<|endoftext|> <s> </s> <unk> <0x41>", "a\x00b \x1c \x85 c", "word " * 400, "nosp" * 700, "ﬁne Ａ ½ ́x  y", "don't we'll it's 12,345.6!!", "ab ab ab ab",
]


@pytest.fixture(scope="module")
def tokens_of():
    a_path, b_path = alignment.default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = _byte_letters()

    def run(text):
        """[(id, bytes)] of both sides, or two empty lists."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return (left, right) if b"".join(t for _, t in left) == whole == b"".join(t for _, t in right) else ([], [])

    return run


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(rows, tokens_of):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, tokens_of(text))
        links = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        counts.update(links)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts, low = [], 0
        for high in ends:
            sides = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)]
            parts.append("|".join(sides))
            low = high
        docs.append((doc_id, len(a), len(b), links, parts))
    tops = Counter()
    for (x, y), n in counts.items():
        tops[y] = max(tops[y], n)
    out = []
    for doc_id, n_a, n_b, links, parts in docs:
        best, total = sum(counts[p] == tops[p[1]] for p in links), sum(counts[p] for p in links)
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(parts), len(links), best, total, digest))
    return sorted(out, key=repr), counts, [";".join(d[4]) for d in docs]


def frame(spark, rows):
    wide = [(*r, "clash", 1, b"x") for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, groups string, run int, heads binary").repartition(3)


def ours(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("flush", "cells"), [(1, 1), (40, 7), (alignment.FLUSH, None)])
def test_against_plain(spark, tokens_of, flush, cells):
    rng = random.Random(flush)
    rows = [*enumerate(ODD), (None, "no id"), (9, ODD[9]), (9, ODD[9])]
    rows += [(100 + i, "".join(rng.choices("abzé .,\n 日t", k=rng.randint(1, 60)))) for i in range(60)]
    want, _, _ = plain(rows, tokens_of)
    assert ours(alignment.align(frame(spark, rows), flush=flush, cells=cells)) == want


def test_blocks_stretches_and_forgetting(spark, tokens_of, monkeypatch):
    monkeypatch.setattr(alignment.stretches, "__defaults__", (9,))
    for name, value in (("STRETCH", 9), ("BLOCK", 3)):
        monkeypatch.setattr(alignment, name, value)
    known = alignment.Aligner(*alignment.default_paths())
    texts = [t or "" for t in ODD]
    for _ in range(2):
        found = [known.text_of(e).decode() for e in known(texts)]
        assert found == plain(list(enumerate(ODD)), tokens_of)[2]
        known.forget()
    run = alignment._Run()
    for i, e in enumerate(known(texts)):
        run.add(known, i, e)
    rows = run.rows(known, 5, 4).to_pylist()
    merged = [e for r in rows if r["cell"] is not None for e in alignment._read(5, r["pairs"])]
    counts = plain(list(enumerate(ODD)), tokens_of)[1]
    assert {(p & 0xFFFFFFFF, p >> 32): n for p, _, n in merged} == dict(counts) and len(merged) == len(counts)


def test_pairs_and_groups(spark, tokens_of):
    rows = list(enumerate(ODD))
    _, counts, groups = plain(rows, tokens_of)
    df = frame(spark, rows)
    merged = alignment.merge(alignment.spill(df, flush=30))
    assert {(r.a_id, r.b_id): r.n_links for r in alignment.pair_counts(merged).collect()} == dict(counts)
    assert {r.doc_id: r.groups for r in alignment.groups(df).collect()} == dict(enumerate(groups))


def test_empty(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    assert ours(alignment.align(empty)) == []
    assert ours(alignment.align(frame(spark, [(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, tokens_of):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    few = [(i, t if t is None or len(t) < 4000 else t[:3000]) for i, t in docs]
    want, _, _ = plain(few, tokens_of)
    assert ours(alignment.align(spark.createDataFrame(few, "doc_id long, text string"))) == want
    got = QUERIES["op12_alignment"](spark, SF).collect()
    sizes = {i: tuple(map(len, tokens_of(t))) for i, t in docs}
    assert {r.doc_id: (r.n_a, r.n_b) for r in got} == sizes
