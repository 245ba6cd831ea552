"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A text is its set of distinct lower-cased words. A word's features are the word and its beginnings of 3 to 8 letters, hashed, so
forms that were never seen share what was learned of their stem. One weight vector serves all thresholds: the chance of a grade
above j is sigmoid(s - threshold j) with s the sum of the weights of the text's features; the output is the expected grade, the
likeliest grade, and whether a grade above 0 is likelier than not.

Labels say only toxic or not. Grades above 0 are the thirds of toxic sample texts by their number of marker words, a marker being a
feature at least ``MARK`` times as frequent in toxic texts as in others (chi-square at least ``TOLD``). Training takes a bounded sample (``PER_CLASS`` texts of
each label, of at most ``MAX_CHARS`` letters) and all their features seen in at least ``SEEN`` texts; it minimises the negative
log-likelihood with an L1 term by proximal steps of per-coordinate size. Features that tell the labels apart by themselves
(chi-square at least ``TOLD``) are fitted first; then all others, rare words among them, are fitted to what the first leave
unexplained, with an L1 term in proportion to the chance slope of a feature so often seen. Defined results: null and word-less texts have s = 0 and so the grade that the thresholds
give without evidence (0); without labels of both kinds every severity is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import labelled_sample

BITS = 20
PER_CLASS = 2000
MAX_CHARS = 20_000
SEEN = 3
TOLD = 12.0  # chi-square of the presence and the label, at least, of a marker and of what is fitted first
MARK = 8.0
GRADES = 4
STEPS = 300
RATE, L1 = 0.3, 2e-5
RARE_L1 = 1.7  # of the other features, in standard errors: one in SEEN toxic texts and no other can still get a weight
ROUNDS = 8
SWEEPS = 4
GROW, MOST_SCALE = 1.15, 20.0
PAYS = 0.95  # of the loss that a step further may leave; less gain is more likely the sample's own noise
STEMS = (3, 4, 5, 6, 7, 8)
_WORDS = re.compile(r"[^\W\d_]+").findall
_CACHE = 200_000
BLOCK = 1 << 18  # features that training looks at at a time


def word_features(word: str, bits: int = BITS) -> list[int]:
    mask = (1 << bits) - 1
    parts = ["=" + word] + [word[:k] for k in STEMS if len(word) >= k]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & mask for p in parts]


@dataclass
class Ordinal:
    weights: np.ndarray  # one for each hashed feature
    thresholds: np.ndarray  # ascending

    def above(self, s: np.ndarray) -> np.ndarray:
        """Chance of a grade above each threshold: [text, threshold]."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - s[:, None], -35, 35)))


@dataclass
class Bag:
    """Features of texts, one text after the other. Sums go over about ``BLOCK`` features at a time in the order of the whole, so blocks change no bit."""

    flat: np.ndarray
    lengths: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """First text and the one after the last, each feature's text counted from the first, the features."""
        ends, first = np.concatenate([[0], np.cumsum(self.lengths)]), 0
        while first < len(self.lengths):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK, side="right")) - 1)
            yield first, last, np.repeat(np.arange(last - first), self.lengths[first:last]), self.flat[ends[first] : ends[last]]
            first = last

    def texts(self) -> Iterator[np.ndarray]:
        begin = 0
        for n in self.lengths.tolist():
            yield self.flat[begin : begin + n]
            begin += n

    def by_text(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each text's features."""
        return np.concatenate([np.bincount(of, weights=weights[at], minlength=last - first) for first, last, of, at in self.blocks()])

    def by_feature(self, values: np.ndarray, size: int) -> np.ndarray:
        """Sum of the values of the texts that have a feature, as often as they have it."""
        total = np.zeros(size)
        for first, last, of, at in self.blocks():
            np.add.at(total, at, values[first:last][of])
        return total

    def only(self, kept: np.ndarray, size: int) -> Bag:
        """The ``kept`` features, numbered in their order."""
        rank = np.full(size, -1, np.int32)
        rank[kept] = np.arange(len(kept))
        flat, lengths = [], []
        for first, last, of, at in self.blocks():
            there = rank[at] >= 0
            flat.append(rank[at[there]])
            lengths.append(np.bincount(of[there], minlength=last - first))
        return Bag(np.concatenate(flat), np.concatenate(lengths))


def fit(texts: list[np.ndarray], toxic: np.ndarray, bits: int = BITS, grades: int = GRADES) -> Ordinal:
    """``texts``: feature numbers of each text, once for each distinct word that has them."""
    if not len(toxic) or toxic.min() == toxic.max():
        return Ordinal(np.zeros(1 << bits, np.float32), np.full(grades - 1, 35.0))
    bag = Bag(np.concatenate(texts), np.array([len(f) for f in texts]))
    del texts  # the sample is held once
    there = np.zeros(1 << bits, bool)
    there[bag.flat] = True
    present = np.flatnonzero(there)
    size, bag = len(present), bag.only(present, len(there))
    seen = {y: np.zeros(size) for y in (0, 1)}
    for f, t in zip(bag.texts(), toxic, strict=True):
        seen[int(t)][np.unique(f)] += 1
    n1, n0 = (toxic == 1).sum(), (toxic == 0).sum()
    n = n1 + n0
    a, b = seen[1], seen[0]
    told = np.maximum(np.abs(a * (n0 - b) - b * (n1 - a)) - n / 2, 0) ** 2 * n / np.maximum((a + b) * (n - a - b) * float(n1 * n0), 1)
    ratio = ((a + 0.1) / n1) / ((b + 0.1) / n0)
    marker = (ratio >= MARK) & (told >= TOLD)
    marks = np.array([marker[f].sum() for f in bag.texts()])
    cut = np.quantile(marks[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    y = np.where(toxic == 1, 1 + np.searchsorted(cut, marks, side="left"), 0)
    share = np.where(toxic == 1, 0.5 / n1, 0.5 / n0)  # toxic and other texts weigh alike, however many there are
    noise = 0.5 * np.sqrt(a * (0.5 / n1) ** 2 + b * (0.5 / n0) ** 2)  # of the slope of a feature that tells nothing
    whole, theta, base = np.zeros(size), np.arange(1.0, grades), np.zeros(n)

    def slopes(s: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the loss in s and in the thresholds."""
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            high, low = (1 / (1 + np.exp(-(edge[y + k] - s))) for k in (1, 0))
        p = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / p * share, low * (1 - low) / p * share
        return (1 - high - low) * share, np.array([-up[y == j].sum() + down[y == j + 1].sum() for j in range(grades - 1)])

    def loss(s: np.ndarray, theta: np.ndarray) -> float:
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            high, low = (1 / (1 + np.exp(-(edge[y + k] - s))) for k in (1, 0))
        return float(-(np.log(np.maximum(high - low, 1e-12)) * share).sum())

    def descend(kept: np.ndarray, l1: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the ``kept`` features beside ``base``, and thresholds."""
        own = bag.only(kept, size)
        w = np.zeros(len(kept))
        gw2, gt2 = np.full(len(kept), 1e-8), np.full(grades - 1, 1e-8)
        for _ in range(STEPS):
            slope, gt = slopes(base + own.by_text(w), theta)
            gw = own.by_feature(slope, len(kept))
            gw2 += gw * gw
            gt2 += gt * gt
            step = RATE / np.sqrt(gw2)
            w = w - step * gw
            w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            theta = np.sort(theta - RATE / np.sqrt(gt2) * gt)
        return w, theta

    def set_apart(s: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """The likeliest thresholds for given sums, one after the other by halving: the loss is convex in each."""
        theta = theta.copy()
        for _ in range(SWEEPS):
            for j in range(grades - 1):
                low = theta[j - 1] if j else s.min() - 10
                high = theta[j + 1] if j < grades - 2 else s.max() + 10
                for _ in range(40):
                    theta[j] = (low + high) / 2
                    if slopes(s, theta)[1][j] > 0:
                        high = theta[j]
                    else:
                        low = theta[j]
        return theta

    plain = (a + b >= SEEN) & (told >= TOLD)
    if plain.any():
        kept = np.flatnonzero(plain)
        whole[kept], theta = descend(kept, np.full(len(kept), L1 / 10), theta)
        base = bag.by_text(whole)
        # Single weights grow slowly where texts are easily told apart: go on along all of them at once while it pays.
        scale, theta = 1.0, set_apart(base, theta)
        least = loss(base, theta)
        while scale < MOST_SCALE:
            further = set_apart(base * scale * GROW, theta * GROW)
            now = loss(base * scale * GROW, further)
            if now > PAYS * least:
                break
            scale, theta, least = scale * GROW, further, now
        whole, base = whole * scale, base * scale
    # All others, for what is left: features whose slope the L1 term does not hold at 0, until there is none more.
    others, active = (a + b >= SEEN) & ~plain, np.zeros(size, bool)
    s, first = base, theta
    for _ in range(ROUNDS):
        slope, _ = slopes(s, theta)
        pull = np.abs(bag.by_feature(slope, size))
        more = others & ~active & (pull > RARE_L1 * noise)
        if not more.any():
            break
        active |= more
        kept = np.flatnonzero(active)
        whole[kept], theta = descend(kept, RARE_L1 * noise[kept], first)
        s = bag.by_text(whole)
    weights = np.zeros(len(there), np.float32)
    weights[present] = whole
    return Ordinal(weights, theta)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bits: int = BITS) -> Ordinal:
    """The sample's features are made by the workers; the likelihood is minimised over the bounded sample."""

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        words = (sorted(set(_WORDS(t.lower()))) for t in texts)
        return pd.Series([zlib.compress(np.array([x for w in ws for x in word_features(w, bits)], np.int32).tobytes(), 1) for ws in words])

    rows = labelled_sample(docs, labels, label, PER_CLASS, MAX_CHARS).select("doc_id", "label", hashed("text").alias("f")).collect()
    rows.sort(key=lambda r: r.doc_id)
    toxic = np.array([r.label for r in rows])
    return fit([np.frombuffer(zlib.decompress(r.f), np.int32) for r in rows], toxic, bits)


def grade(docs: DataFrame, model: Ordinal, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with severity (expected grade), grade and toxic. Nothing is shuffled; columns of these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ordinal, known = sent.value, {}
        for texts in parts:
            sums = np.zeros(len(texts))
            for i, t in enumerate(texts):
                words = set(_WORDS(t.lower())) if t else ()
                if len(known) > _CACHE:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = float(ordinal.weights[word_features(w, bits)].sum())
                sums[i] = sum(sorted(map(known.__getitem__, words)))
            above = ordinal.above(sums)
            chances = np.concatenate([np.ones((len(sums), 1)), above], 1) - np.concatenate([above, np.zeros((len(sums), 1))], 1)
            yield pd.DataFrame({"severity": above.sum(1), "grade": chances.argmax(1).astype(np.int32), "toxic": above[:, 0] >= 0.5})

    return docs.withColumn("_tox", predict(F.col(text_col))).withColumns({c: F.col(f"_tox.{c}") for c in ("severity", "grade", "toxic")}).drop("_tox")
