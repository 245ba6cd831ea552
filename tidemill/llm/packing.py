"""Harmonic packing: documents' token ids cut into pieces of a few length classes, a fixed number of pieces to a sequence.

A class k holds pieces of at most capacity / k ids, and k of them fill a sequence, so a worker packs its own pieces as they
come, class by class, without seeing any other worker's. A document is cut into full sequences first; what remains goes whole
into the smallest class that fits if that wastes at most ``slack`` of the class's slot, and is cut at the largest slot below it
otherwise. Each worker is left with fewer than k pieces of class k. These few are packed the same way by groups of workers, and
again by groups of groups, until one group remains; its rest (fewer than k pieces of each class) is laid end to end, cut where
sequences end, and the last, partly filled sequence is cut into power-of-two lengths that need no padding.

Defined results: a null or empty text is one document of just the end id; repeated rows are packed each for itself; an empty
table gives no rows. doc_id may be null or repeated, other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import columns, lean, settle, written
from tidemill.llm.tokens import default_path, tokenizer

CAPACITY = 2048
END_ID = 1
SLACK = 0.02
#: Pieces to a sequence. Every class costs each worker at most k - 1 pieces that wait for the next round.
CLASSES = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 28, 32, 40, 48, 56, 64, 80, 96, 128)
FAN_IN = 16

_PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "size_class int, worker int, ids binary"
)
_NAMES = [c.split()[0] for c in _PIECE.split(", ")]


def cuts(n: int, capacity: int = CAPACITY, classes: tuple[int, ...] = CLASSES, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of ``n`` ids, in order."""
    slots = [(capacity // k, k) for k in sorted(classes)]  # from the longest
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        slot, k = min((s for s in slots if s[0] >= rest), default=slots[0])
        if slot - rest <= slack * slot or slot == slots[-1][0]:
            out.append((rest, k))
            break
        slot, k = next(s for s in slots if s[0] < rest)
        out.append((slot, k))
        rest -= slot
    return out


class _Bins:
    """Pieces waiting by class; ``add`` gives a full sequence's rows, ``rest`` what waits."""

    def __init__(self, base: int) -> None:
        self.base, self.made, self.waiting = base, 0, {}

    def add(self, piece: tuple, k: int) -> list[tuple]:
        open_ = self.waiting.setdefault(k, [])
        open_.append(piece)
        return self.close(self.waiting.pop(k)) if len(open_) == k else []

    def close(self, pieces: list[tuple]) -> list[tuple]:
        rows, at, sequence = [], 0, self.base + self.made
        self.made += 1
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, at, None, None, None))
            at += len(ids) // 4
        return rows

    def rest(self, worker: int) -> list[tuple]:
        return [(d, s, len(i) // 4, None, t, None, None, k, worker, i) for k, ps in self.waiting.items() for d, s, i, t in ps]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return columns(rows, _NAMES, set(_NAMES[:-1]))


def _end_to_end(bins: _Bins, capacity: int) -> list[tuple]:
    """Pack all that waits without a gap; the last sequence is cut into power-of-two lengths."""
    pieces = [p for _, ps in sorted(bins.waiting.items()) for p in ps]
    left, sizes = sum(len(p[2]) // 4 for p in pieces), []
    while left:
        sizes.append(capacity if left >= capacity else 1 << (left.bit_length() - 1))
        left -= sizes[-1]
    rows: list[tuple] = []
    queue = iter(pieces)
    doc, start, ids, total = next(queue, (None, 0, b"", 0))
    for size in sizes:
        filled = []
        while size:
            if not ids:
                doc, start, ids, total = next(queue)
            take = ids[: 4 * size]
            filled.append((doc, start, take, total))
            ids, start, size = ids[len(take) :], start + len(take) // 4, size - len(take) // 4
        rows += bins.close(filled)
    return rows


def _by_group(level: int, last: bool, capacity: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """Pack what a group of workers was left with; the last group packs all of it."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bins, rows = _Bins(level << 60 | int(key[0]) << 32), []
        part = part.sort_values(["worker", "size_class", "doc_id", "start"], kind="stable")
        for doc, start, total, k, ids in part[["doc_id", "start", "doc_tokens", "size_class", "ids"]].itertuples(index=False):
            rows += bins.add((None if doc is None else int(doc), int(start), ids, int(total)), int(k))
        return _frame(rows + (_end_to_end(bins, capacity) if last else bins.rest(int(key[0]))))

    return run


def pack(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    classes: tuple[int, ...] = CLASSES,
    slack: float = SLACK,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = settle(docs.sparkSession)
    shared = tokenizer(spark, path or default_path())
    end = int(end_id).to_bytes(4, "little")

    def by_worker(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, worker = shared.value().encode, TaskContext.get().partitionId()
        bins = _Bins(worker << 32)
        for part in parts:
            rows: list[tuple] = []
            for name, text in zip(part["doc_id"], part["text"], strict=True):
                ids, start = encode(text) + end, 0
                doc, total = None if name is None else int(name), len(ids) // 4
                for length, k in cuts(total, capacity, classes, slack):
                    rows += bins.add((doc, start, ids[4 * start : 4 * (start + length)], total), k)
                    start += length
            yield _frame(rows)
        yield _frame(bins.rest(worker))

    # As text, because pandas has no long column with nulls.
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(source.mapInPandas(lean(by_worker), _PIECE), "pack")
    done, level = [pieces.where(F.col("size_class").isNull())], 0
    waiting = pieces.where(F.col("size_class").isNotNull())
    groups = (waiting.agg(F.max("worker")).first()[0] or 0) + 1
    while True:
        level, groups = level + 1, -(-groups // FAN_IN)
        last = groups == 1
        named = waiting.withColumn("doc_id", F.col("doc_id").cast("string"))
        packed = named.groupBy(F.floor(F.col("worker") / FAN_IN).cast("int").alias("group")).applyInPandas(_by_group(level, last, capacity), _PIECE)
        if last:
            done.append(packed)
            break
        packed = written(packed, "pack")
        done.append(packed.where(F.col("size_class").isNull()))
        waiting = packed.where(F.col("size_class").isNotNull())
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*_NAMES[:7])
