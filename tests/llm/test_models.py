"""Language, toxicity, quality and main text: held-out accuracy, brute force and odd rows."""

from __future__ import annotations

import gc
import html
import math
import random
import re
import string
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from tidemill.llm import html_extract, language, packing, quality, queries, toxicity
from tidemill.llm.common import held_out, labelled_sample

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "x", "x"), (2, "", "x", "x"), (3, "123 *** \n", "x", "x"), (4, "the " * 50_000, "x", "x"), (4, "the " * 50_000, "x", "x"), (None, "und der", "x", "x")]
CLASH = "doc_id long, text string, score string, toxic string"


def auc(y, s):
    pairs = [(a > b) + 0.5 * (a == b) for a, i in zip(s, y) if i for b, j in zip(s, y) if not j]
    return sum(pairs) / len(pairs)


def test_held_out_fifth(spark):
    df = spark.range(2000).select(held_out(F.col("id")).alias("h"))
    assert 300 < df.where("h").count() < 500
    assert spark.sql("select cast(null as long) as id").select(held_out(F.col("id"))).first()[0]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(500)] + [(7, "x" * 99), (None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 1), (3, 1), (None, 1), (8, None)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10, 50).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 20 and {r.label for r in rows} == {0, 1} and all(len(r.text) <= 50 for r in rows)


def naive_phrases(text, sample):
    letters, count, at = text, 0, 0
    while at < len(letters):
        n = 1
        while at + n < len(letters) and letters[at : at + n + 1] in sample and letters[at : at + n] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


def test_phrases_are_longest_matches():
    rng = random.Random(4)
    samples = {k: "".join(rng.choices("abcd"[:n], k=300)) for k, n in (("x", 2), ("y", 4))}
    automata = language.Automata(samples)
    texts = ["".join(rng.choices("abcde", k=n)) for n in (1, 5, 60, language.LANE)]
    for t, counts in zip(texts, automata.phrases(texts), strict=True):
        assert counts.tolist() == [naive_phrases(t, samples[k]) for k in automata.names]
    long = "".join(rng.choices("abcd", k=3 * language.LANE + 7))
    lanes = [long[i : i + language.LANE] for i in range(0, len(long), language.LANE)]
    assert automata.phrases([long])[0].tolist() == [sum(naive_phrases(x, samples[k]) for x in lanes) for k in automata.names]


def test_rare_scripts_are_told_apart():
    rng = random.Random(8)
    scripts = {"en": range(97, 123), "ru": range(0x430, 0x450), "el": range(0x3B1, 0x3CA), "ja": range(0x3041, 0x3097), "ko": range(0xAC00, 0xAC00 + 900)}
    words = {k: ["".join(chr(rng.choice(cs)) for _ in range(rng.randint(2, 5))) for _ in range(80)] for k, cs in scripts.items()}
    words["zh"] = ["".join(chr(rng.choice(range(0x4E00, 0x4E00 + 900))) for _ in range(rng.randint(2, 5))) for _ in range(80)]
    words["zz"] = [w[::-1] for w in words["zh"]]  # the same letters in another order
    samples = {k: " ".join(rng.choices(ws, k=2500 if k == "en" else 400)) for k, ws in words.items()}
    texts = {k: " ".join(rng.choices(ws, k=60)) for k, ws in words.items()}
    for cells in (language.CELLS, 200_000, 0):  # tables, both, lists
        automata = language.Automata(samples, cells)
        counts = automata.phrases(list(texts.values()))
        assert counts.tolist() == [[naive_phrases(t, samples[k]) for k in automata.names] for t in texts.values()]
        assert [automata.names[i] for i in counts.argmin(1)] == list(texts)


def test_sample_bound_is_of_each_language(spark):
    rows = [(i, "abc " * 1000, f"l{i % 9}") for i in range(900)]
    samples = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(samples) == 9 and {len(t) for t in samples.values()} == {language.LANG_CHARS}


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op7_language(spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    odd = language.identify(spark.createDataFrame(ODD, CLASH), language.learn(docs)).collect()
    assert [r.lang_pred for r in odd[:3]] == ["und"] * 3 and odd[3].lang_pred == odd[4].lang_pred == "en" and odd[5].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in odd)
    none = language.identify(spark.createDataFrame(ODD, CLASH), language.learn(docs.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    one = language.learn(docs.where("lang = 'fr'"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs.limit(3), one).collect()} == {("fr", 1.0)}


def test_models_leave_the_workers_with_their_stage(spark):
    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("many words of one tongue").alias("text")).repartition(4)
    assert language.identify(texts, {"en": "many words of one tongue", "de": "viele worte einer sprache"}).where("lang_pred = 'en'").count() == 400
    assert packing.pack(texts).agg(F.sum("length")).first()[0] > 400

    def left(parts):
        for part in parts:
            held = [type(x).__name__ for x in gc.get_objects()]
            yield part.assign(id=held.count("Automata") + held.count("WordTokenizer"))

    assert spark.range(0, 400, 1, 8).mapInPandas(left, "id long").agg(F.max("id")).first()[0] == 0


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = toxicity.grade(docs, model).join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    own = [r for r in rows if r.y == 1]
    assert sum(r.toxic for r in own) >= 0.8 * len(own)
    assert sum(r.toxic for r in rows if r.y == 0) <= 0.02 * len(rows)
    assert np.all(np.diff(model.thresholds) >= 0)
    odd = toxicity.grade(spark.createDataFrame(ODD, CLASH), model).collect()
    assert not any(r.toxic for r in odd) and all(0 <= r.severity <= toxicity.GRADES - 1 for r in odd)
    blind = toxicity.train(docs, labels.limit(0))
    assert {(r.toxic, r.grade) for r in toxicity.grade(docs, blind).collect()} == {(False, 0)}


def test_ordinal_fit_grows_with_evidence():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    texts = [np.concatenate([rng.integers(100, 400, 30), rng.integers(0, 5, rng.integers(1, 9)) if t else []]).astype(np.int64) for t in y]
    model = toxicity.fit(texts, y, bits=10)
    s = np.array([model.weights[t].sum() for t in texts])
    expected = model.above(s).sum(1)
    assert ((model.above(s)[:, 0] >= 0.5) == (y == 1)).mean() > 0.97
    hits = np.array([(t < 5).sum() for t in texts])
    assert np.corrcoef(hits[y == 1], expected[y == 1])[0, 1] > 0.8


def test_ordinal_fit_holds_its_sample_once(monkeypatch):
    rng = np.random.default_rng(3)
    y = np.arange(400) % 2
    texts = [np.concatenate([rng.integers(1000, 50_000, 6000), np.zeros(9 * t, int) + 7]).astype(np.int32) for t in y]
    tracemalloc.start()
    model = toxicity.fit(texts, y, bits=16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * sum(t.nbytes for t in texts)  # more than eight times before
    monkeypatch.setattr(toxicity, "BLOCK", 1000)
    again = toxicity.fit(texts, y, bits=16)
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.thresholds, again.thresholds)


def test_rare_toxic_words_are_learned():
    rng = np.random.default_rng(5)
    y = np.repeat([1, 0], 500)
    # Each toxic text has two of 160 toxic words, so a word is in about six texts of 1000; all texts have common words.
    texts = [np.concatenate([rng.integers(200, 500, 20), rng.choice(160, 2, replace=False) if t else np.zeros(0)]).astype(np.int64) for t in y]
    model = toxicity.fit(texts, y, bits=10)
    fresh = [np.concatenate([rng.integers(200, 500, 20), rng.choice(160, 2, replace=False) if t else np.zeros(0)]).astype(np.int64) for t in y]
    said = model.above(np.array([model.weights[t].sum() for t in fresh]))[:, 0] >= 0.5
    assert said[y == 1].mean() > 0.75 and said[y == 0].mean() < 0.1  # none of them before rare features were fitted


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.train(docs, labels)
    rows = quality.score(docs, weights).where(held_out(F.col("doc_id"))).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert auc([r.quality for r in rows], [r.score for r in rows]) > 0.95
    odd = quality.score(spark.createDataFrame(ODD, CLASH), weights).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in odd) and odd[0].score == odd[1].score
    assert quality.score(docs.limit(2), quality.train(docs, labels.limit(0))).first().score == 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div class="page-wrap"><header><h1>Site</h1></header>
<div class="main-content"><div class="article-body"><header><h2>Head</h2></header><p>First &amp; real   paragraph<br>of the story, with some words.<p>Second
paragraph; it has <b>bold</b> text &lt;here&gt;.<script>var a = "<p>no</p>";</script><!-- <p>no</p> --><table><tr><td>one<td>two</table>
<aside>Aside text here</aside></div><div class="sidebar"><p>Sidebar paragraph with words, and more words in it.</p></div>
<div id=comments><p>Nice post! I like this very much, thanks.</p></div><div class='notice'>Notice text</div><form><p>Subscribe now</p></form></div>
<footer>foot</footer></div></body></html>"""


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = html_extract.train(pages)
    for r in html_extract.extract(pages, trees).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = (html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner.replace("<br>", " ")))
        assert r.text == "\n\n".join(t for t in (" ".join(b.split()) for b in blocks) if t) and r.n_chars == len(r.text)
    rows = [(1, PAGE), (2, None), (3, ""), (4, "bare &gt; text"), (5, "<p>" + "long words " * 30_000), (6, "<div><p>open <a href='x"), (7, "<" * 50), (8, "</p></div>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df, trees).collect()}
    for part in ("First & real paragraph of the story, with some words.", "Second paragraph; it has bold text <here>.", "one\n\ntwo"):
        assert part in got[1].split("\n\n") or part in got[1]
    for part in ("Aside", "Sidebar", "Nice", "Notice", "Subscribe", "foot", "Site", "no<", "var"):
        assert part not in got[1]
    assert (got[2], got[3], got[4], got[8]) == ("", "", "bare > text", "") and got[5].count("words") == 30_000
    assert html_extract.extract(df.limit(0), trees).count() == 0
    # Names that say nothing: links and length tell the menu and the list of headlines.
    plain = """<body><div class='c1'><a href='/'>Home</a> <a href='/n'>News</a> <a href='/s'>Sports</a> <a href='/w'>Weather today</a></div><div class='c2'>
        <div class='c3'><h1>River floods the town</h1><p>The river rose two metres in the night, and by morning the square was under water.</p><p>Nobody was hurt, but
        many shops will stay closed for weeks, the mayor said.</p></div><div class='c4'><a href='/1'>Storm warning for the coast</a><br><a href='/2'>New bridge
        planned in the north</a><br><a href='/3'>Ten ways to save heat</a></div></div></body>"""
    text = html_extract.extract(spark.createDataFrame([(1, plain)], "page_id long, html string"), trees).first().text
    assert [b.split()[0] for b in text.split("\n\n")] == ["River", "The", "Nobody"]


def test_only_hiding_attributes_hide():
    seen = ['title="The hidden valley"', 'class="md hidden lg:block"', 'data-x="display:none"', "aria-label='aria-hidden=true'", 'aria-hidden="false"', 'style="--display:none-such"', 'href=/hidden', "aria-hidden=true", "aria-hidden = 'true' class='a'"]
    gone = ["hidden", 'hidden=""', "id=x HIDDEN", 'style="color:red; display : none"', "style=display:none", 'class="a"hidden']
    assert [html_extract.parse(f"<div {a}>text</div>")[1].hidden for a in seen + gone] == [False] * len(seen) + [True] * len(gone)


def all_text(page):
    nodes = html_extract.parse(page)
    return html_extract.text_of(nodes, html_extract.decode(nodes, np.full(len(nodes), 0.9)))


def test_quotes_count_after_equals_only():
    assert all_text("<p title=it's>One text here.</p><p>Two text, don't drop.</p>") == "One text here.\n\nTwo text, don't drop."
    assert all_text("<p 'x>one</p><p it's=\"a > b\" y='c > d'>two</p><p = \"e>three</p>") == "one\n\ntwo\n\nthree"
    assert all_text('<p class="open>one</p><p>two</p>') == "one\n\ntwo"  # a quote that never ends is no quote
    assert all_text("a < b <3 </ x <!doctype> c <a href=/x/y/>link</a> d <br/>e") == "a < b <3 </ x c link d e"
    assert all_text("<p>one</p><!-- <p>no</p>") == all_text("<p>one</p><a href='x' ") == "one"


def test_long_and_broken_pages_take_little_time():
    many = "<body>" + "<p>some words, more words.</p>" * 16_000 + "</body>"
    for page in (many, "<a " * 100_000, "<a href='x' " * 40_000, "<a href=\"x' " * 40_000, "<!-- " * 100_000, "<" * 300_000, "<p a='" * 60_000 + ">", "</ " * 100_000):
        began = time.process_time()
        html_extract.features(html_extract.parse(page))
        assert time.process_time() - began < 5


def test_formulas_go_with_their_text():
    page = "<article><p>Mass is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> here.</p><nav><math><mi>q</mi></math></nav></article>"
    nodes = html_extract.parse(page)
    for p in (0.01, 0.99):  # whatever the trees say of a formula
        chance = np.array([p if n.formula else 0.01 if n.tag == "nav" else 0.9 for n in nodes])
        assert html_extract.text_of(nodes, html_extract.decode(nodes, chance)) == "Mass is E=mc2 here."
    assert not any(n.formula for n in html_extract.parse("<math><mi>x</mi><p>after</p>") if n.tag == "p")


def test_decoding_never_contradicts():
    rng = np.random.default_rng(2)
    nodes = html_extract.parse(PAGE)
    for _ in range(50):
        kept = html_extract.decode(nodes, rng.random(len(nodes)))
        assert all(kept[n.parent] or not kept[i] for i, n in enumerate(nodes) if i)


def test_parser_survives_noise():
    rng = random.Random(6)
    for _ in range(300):
        page = "".join(rng.choice(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "<b", ">", "&amp;", "<!--", "-->", "<script>", "</script>", rng.choice(string.ascii_letters)]) for _ in range(40))
        nodes = html_extract.parse(page)
        html_extract.text_of(nodes, html_extract.decode(nodes, html_extract.features(nodes)[:, 0] * 0 + 0.9))


def test_every_usable_label_is_sampled(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50), "clash") for i in range(100)] + [(7, None, ""), (8, "y" * 99, "")], "doc_id long, text string, label string")
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit("clash").alias("label"))
    fit = [r.doc_id for r in labels.where(~held_out(F.col("doc_id")) & (F.col("doc_id") < 100)).collect()]
    got = labelled_sample(docs, labels, "quality", 60, 60).collect()
    assert sorted(r.doc_id for r in got) == sorted(fit) and len(fit) > 70
    assert all(r.label == r.doc_id % 2 and r.text is not None for r in got)
    few = labelled_sample(docs, labels, "quality", 9, 60)
    assert {r.label: r["count"] for r in few.groupBy("label").count().collect()} == {0: 9, 1: 9}
    short = labelled_sample(docs, labels, "quality", 60, 10).collect()
    assert short and {r.doc_id for r in short} == {i for i in fit if i % 50 <= 10}
    assert labelled_sample(docs.limit(0), labels, "quality", 60, 60).count() == 0 == labelled_sample(docs, labels.limit(0), "quality", 60, 60).count()


def test_held_out_labels_change_no_score(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels) == quality.train(docs, flipped)).all()
    twice = labels.union(labels.where("quality = 1"))
    assert (quality.train(docs, labels) == quality.train(docs, twice)).all()


def test_ftrl_equals_a_plain_version():
    rng = np.random.default_rng(2)
    model, z, n = quality.Ftrl(bits=3), [0.0] * 9, [0.0] * 9

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(200):
        at, y, share = rng.choice(9, 4, replace=False), int(rng.integers(2)), float(rng.uniform(0.2, 2))
        x = rng.normal(size=4)
        model.update(at, x, y, share)
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in zip(at, x, strict=True))))
        slopes = [share * (p - y) * v for v in x]
        before = [weight(i) for i in at]
        for i, g, w in zip(at, slopes, before, strict=True):
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w
            n[i] += g * g
    assert np.allclose(model.weights(np.arange(9)), [weight(i) for i in range(9)])
