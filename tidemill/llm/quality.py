"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text's tokens are its words and single marks. Its features are hashed n-grams: words and word pairs as written, and runs of one
to three word shapes, where a shape says lower case, capital, upper case, number or mark, how long, and whether the token repeats
the one before. A feature's value is its share of the text's n-grams times ``SCALE``, so long and short texts weigh alike; a text
without tokens has the intercept alone. The score of a text is a sparse dot product with the trained weights.

Training takes a bounded sample (``PER_CLASS`` texts of each label, of at most ``MAX_CHARS`` letters), in the order of a hash of
the id; classes count as often as in all labels. Defined results: null is scored as the empty text; without labels every score
is 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import labelled_sample, learnable

BITS = 18
PER_CLASS = 3000
MAX_CHARS = 20_000
EPOCHS = 3
SCALE = 30.0
ALPHA, BETA, L1, L2 = 0.15, 1.0, 0.3, 0.5
THRESHOLD = 0.3
_TOKENS = re.compile(r"[^\W_]+|[^\w\s]|_").findall
_CACHE = 200_000


def _shape(token: str) -> int:
    if not token[0].isalnum():
        return 0
    kind = 1 if token.isdigit() else 2 if token.islower() else 3 if token.isupper() and len(token) > 1 else 4
    return kind * 4 + min(3, len(token) // 4)


class Hasher:
    """Feature numbers of texts; a token's hash and shape are kept, at most ``_CACHE`` of them."""

    def __init__(self, bits: int = BITS) -> None:
        self.mask, self.seen = (1 << bits) - 1, {}

    def _number(self, token: str) -> int:
        return zlib.crc32(token.encode("utf-8", "surrogatepass")) << 5 | _shape(token)

    def features(self, text: str | None) -> np.ndarray:
        tokens = _TOKENS(text or "")
        if not tokens:
            return np.zeros(0, np.int64)
        seen = self.seen
        if len(seen) > _CACHE:
            seen.clear()
        for t in set(tokens):
            if t not in seen:
                seen[t] = self._number(t)
        both = np.fromiter(map(seen.__getitem__, tokens), np.int64, len(tokens))
        word = both >> 5
        shape = both & 31
        shape[1:] += 32 * (word[1:] == word[:-1])
        parts = [word * 0x9E3779B1, shape * 0x85EBCA77 + 11]
        if len(tokens) > 1:
            parts += [word[1:] * 0xC2B2AE3D + word[:-1] * 0x27D4EB2F + 23, shape[1:] * 0x165667B1 + shape[:-1] * 0x9E3779B1 + 37]
        if len(tokens) > 2:
            parts.append(shape[2:] * 0x165667B1 + shape[1:-1] * 0x9E3779B1 + shape[:-2] * 0xC2B2AE3D + 53)
        mixed = np.concatenate(parts)
        return (mixed ^ (mixed >> 17) ^ (mixed >> 31)) & self.mask


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last weight is the intercept."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: int, weight: float) -> None:
        w = self.weights(at)
        g = weight * (sigmoid(float(w @ x)) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def sigmoid(v: float) -> float:
    return 1 / (1 + np.exp(-min(max(v, -35.0), 35.0)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS) -> np.ndarray:
    """Weights, the intercept last. Features are made by the workers; the updates run over the bounded sample in one pass each."""

    @F.pandas_udf("at binary, counts binary, n int")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        hasher, rows = Hasher(bits), []
        for t in texts:
            f = hasher.features(t)
            at, counts = np.unique(f, return_counts=True)
            rows.append((at.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes(), len(f)))
        return pd.DataFrame(rows, columns=["at", "counts", "n"])

    sample = labelled_sample(docs, labels, label, PER_CLASS, MAX_CHARS)
    rows = sample.select("doc_id", "label", hashed("text").alias("f")).collect()
    usual = {r.label: r["count"] for r in learnable(labels, label).groupBy("label").count().collect()}
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    found = {y: sum(r.label == y for r in rows) for y in (0, 1)}
    share = {y: usual.get(y, 0) / max(1, sum(usual.values())) * len(rows) / max(1, found[y]) for y in (0, 1)}
    model, intercept = Ftrl(bits), 1 << bits
    points = []
    for r in rows:  # numbers stay packed: the whole sample is a few million of them
        at, counts = np.frombuffer(r.f.at, np.int32), np.frombuffer(r.f["counts"], np.int32)
        points.append((np.append(at, intercept), np.append(counts * np.float32(SCALE / max(1, r.f.n)), np.float32(1)), r.label))
    for _ in range(EPOCHS):
        for at, x, y in points:
            model.update(at, x, y, share[y])
    return model.weights(np.arange((1 << bits) + 1)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted. Nothing is shuffled; columns of these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def dot(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher, w = Hasher(bits), sent.value
        for texts in parts:
            out = []
            for t in texts:
                f = hasher.features(t)
                out.append(sigmoid(float(w[-1]) + (float(w[f].sum(dtype=np.float64)) * SCALE / len(f) if len(f) else 0.0)))
            yield pd.Series(out)

    return docs.withColumn("score", dot(F.col(text_col))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
