"""Benchmark decontamination: windows of benchmark words sought in documents by Wu-Manber multi-pattern search.

Words are runs of digits, ASCII letters (lower-cased) and all non-ASCII characters. A pattern is a window of 13 item words, or
a whole shorter item, with a space before, between and after its words; a document is its words in the same form, so an
occurrence always begins and ends at a word. Patterns are put into classes by length (doubling), each with its own table, so
short items do not shorten the jumps for long ones. The scan looks at the block of bytes that ends at the class's shortest
pattern length: if no pattern has the block there, the table says how far to jump; if some have, the bucket of that block names
the patterns that are then compared byte by byte.

Defined results: a null or word-less text has 0 words and is clean; null and word-less items have no windows; items of one id
count once; an item without id hits words but is not counted or named. Result columns replace columns of the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
BLOCK = 8
#: Patterns of one pass, with their item ids, in bytes; a larger benchmark takes several passes over the documents.
PASS_BYTES = 64 << 20

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def spaced(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" " if words else b""


class WuManber:
    """Shift tables, suffix buckets and direct comparison; one class of patterns for each doubling of length."""

    def __init__(self, patterns: Iterable[bytes], block: int = BLOCK) -> None:
        by_class: dict[int, list[bytes]] = {}
        for p in patterns:
            by_class.setdefault(len(p).bit_length(), []).append(p)
        self.classes = []
        for _, group in sorted(by_class.items()):
            m = min(map(len, group))
            b = min(block, m)
            shift: dict[bytes, int] = {}
            buckets: dict[bytes, list[bytes]] = {}
            for p in group:
                for end in range(b, m + 1):
                    key, far = p[end - b : end], m - end
                    if far < shift.get(key, m):
                        shift[key] = far
                buckets.setdefault(p[m - b : m], []).append(p)
            self.classes.append((m, b, shift, buckets))

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, pattern) of every occurrence."""
        size = len(text)
        for m, b, shift, buckets in self.classes:
            get, most, end = shift.get, m - b + 1, m
            while end <= size:
                block = text[end - b : end]
                far = get(block, most)
                if far:
                    end += far
                    continue
                start = end - m
                for p in buckets[block]:
                    if text.startswith(p, start):
                        yield start, p
                end += 1


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(pattern binary, item_id string) of all items, distinct."""

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        found = []
        for t in texts:
            w = words_of(t)
            found.append([spaced(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else [])
        return pd.Series(found)

    return items.select(F.col(id_col).cast("string").alias("item_id"), F.explode(cut(text_col)).alias("pattern")).distinct()


_tables: dict[str, tuple[WuManber, dict[bytes, list[str]]]] = {}


def _search(of: Broadcast, run: str) -> tuple[WuManber, dict[bytes, list[str]]]:
    """The tables of a pass, built once in each Python worker; only the last pass's are kept."""
    if run not in _tables:
        named: dict[bytes, list[str]] = {}
        for pattern, item in of.value:
            named.setdefault(pattern, []).extend([item] if item is not None else [])
        _tables.clear()
        _tables[run] = (WuManber(named), named)
    return _tables[run]


def scan_text(tables: tuple[WuManber, dict[bytes, list[str]]], text: str | None) -> tuple[int, np.ndarray | None, set[str]]:
    """Number of words, which of them are hit (None: no occurrence), ids of the items with occurrences."""
    words = words_of(text)
    line, hit, items, starts = spaced(words), None, set(), None
    search, named = tables
    for start, pattern in search.find(line):
        if hit is None:
            hit = np.zeros(len(words), bool)
            starts = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        first = int(np.searchsorted(starts, start))
        hit[first : first + pattern.count(b" ") - 1] = True
        items.update(named[pattern])
    return len(words), hit, items


def _one_pass(docs: DataFrame, text_col: str, patterns: Broadcast) -> DataFrame:
    """Add this pass's hits to ``_found`` (words, packed hits, number of hits, items)."""
    run = uuid.uuid4().hex

    @F.pandas_udf("n_words long, hits binary, n_hit long, items array<string>")
    def scan(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tables = _search(patterns, run)
        for texts, before, known in parts:
            rows = []
            for text, bits, names in zip(texts, before, known, strict=True):
                n, hit, items = scan_text(tables, text)
                if bits is not None:
                    old = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                    hit = old if hit is None else hit | old
                if names is not None:
                    items.update(names)
                packed = None if hit is None else np.packbits(hit).tobytes()
                rows.append((n, packed, 0 if hit is None else int(hit.sum()), sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "hits", "n_hit", "items"])

    return docs.withColumn("_found", scan(F.col(text_col), F.col("_found.hits"), F.col("_found.items")))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids (sorted), items_sha256 and contaminated.

    The documents are scanned where they lie; nothing of them is shuffled. Patterns are broadcast, at most ``pass_bytes`` at a
    time: their size is summed first, and a larger benchmark is dealt out by hash to several passes, with a checkpoint
    between them.
    """
    spark = docs.sparkSession
    patterns = windows(items, id_col, item_text_col, window)
    size = F.sum(F.length("pattern") + F.coalesce(F.length("item_id"), F.lit(0)))
    total = patterns.agg(size).first()[0] or 0
    passes = max(1, -(-total // pass_bytes))
    df = docs.withColumn("_found", F.lit(None).cast("struct<n_words:bigint,hits:binary,n_hit:bigint,items:array<string>>"))
    for k in range(passes):
        mine = patterns if passes == 1 else patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == k)
        held = [(bytes(r.pattern), r.item_id) for r in mine.select("pattern", "item_id").collect()]
        df = _one_pass(df, text_col, spark.sparkContext.broadcast(held))
        if k + 1 < passes:
            df = df.checkpoint()
    found = F.col("_found")
    return (
        df.withColumn("n_words", found.n_words)
        .withColumn("n_hit", found.n_hit)
        .withColumn("n_items", F.size(found["items"]).cast("long"))
        .withColumn("item_ids", found["items"])
        .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort(found["items"]), ",").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("_found")
    )

