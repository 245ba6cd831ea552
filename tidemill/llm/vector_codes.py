"""Vector code compression: a short code of codebook entries for every vector, learned and assigned in whole numbers.

Components become floor(scale * x). Vectors are cut into equal consecutive parts, each with its own codebook: it starts as the parts of
the smallest ids, and every round assigns all parts to their nearest entries and moves an entry to the floored mean of its parts.

Nearest entries are searched in transformed space. Parts and entries are padded with zeros to P, a power of two, and go
through an integer Walsh-Hadamard transform, which makes every squared distance P times as large. Its coefficients come in sequency
order (by their number of sign changes), where the first ones carry most of a smooth vector's energy. Scaled squared differences are
added up in that order; an entry whose sum exceeds the distance of an entry that is known in full is out, as nothing can be
subtracted any more. All numbers are integers: 64-bit ones where the largest possible sum fits, unlimited ones otherwise.

A round sends one row of sums for each entry of each task; codebooks, whose size is a parameter, are all that the driver holds. Vectors
are read again in each round, so lost executors cost nothing but their tasks.

Defined results: vectors that are null, or hold a component that is null, not finite or of 2^30 or more, are left out. Shorter vectors
count as padded with zeros to the longest one's length, and this to a multiple of the parts. Rows without an id are coded but start no
entry; repeated rows count each; equal ids start entries in the order of their vectors. Ties go to the lower entry. With fewer
vectors than entries there are as many entries; without any there is no row. Errors beyond a long stay at its maximum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.llm.common import settle, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 30
DENSE = 4  # coefficients that are added up for all entries before any is eliminated
ROWS = 1024  # parts that are compared at a time
HELD = 1 << 20  # vectors whose sums a task keeps before it sends them
_LONG = (1 << 63) - 1


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix by their number of sign changes: bit-reversed Gray codes."""
    bits = size.bit_length() - 1
    gray = [s ^ (s >> 1) for s in range(size)]
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray], np.int64)


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of each row, padded with zeros to a power of two, in sequency order."""
    n, width = x.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), x.dtype)
    out[:, :width] = x
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        a, b = pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]
        out = np.stack([a, b], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency_order(size)]


def _fitting(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same numbers in a type that holds every sum of squared differences."""
    most = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if (2 * most) ** 2 * max(1, x.shape[1]) > _LONG:
        return x.astype(object), c.astype(object)
    return x, c


def nearest(x: np.ndarray, c: np.ndarray, dense: int = DENSE, visited: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of transformed rows ``x``, the nearest of transformed entries ``c`` (the lower of equal ones) and the scaled distance.

    ``visited`` receives the number of coefficients that were compared.
    """
    x, c = _fitting(x, c)
    size, index, distance = x.shape[1], np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for at in range(0, len(x), ROWS):
        rows = x[at : at + ROWS]
        known = min(dense, size)
        sums = np.zeros((len(rows), len(c)), x.dtype)
        for j in range(known):
            sums += (rows[:, j, None] - c[None, :, j]) ** 2
        count = sums.size * known
        guess = sums.argmin(axis=1)
        best = ((rows - c[guess]) ** 2).sum(axis=1)
        count += rows.size
        row, entry = np.nonzero(sums <= best[:, None])
        left = sums[row, entry]
        while known < size:
            step = min(known, size - known)
            left = left + ((rows[row, known : known + step] - c[entry, known : known + step]) ** 2).sum(axis=1)
            count += len(row) * step
            known += step
            stay = left <= best[row]
            row, entry, left = row[stay], entry[stay], left[stay]
        begins = np.searchsorted(row, np.arange(len(rows)))  # the guess itself always stays
        best = np.minimum.reduceat(left, begins)
        winner = np.flatnonzero(left == best[row])
        first = winner[np.searchsorted(row[winner], np.arange(len(rows)))]
        index[at : at + ROWS], distance[at : at + ROWS] = entry[first], best
        if visited is not None:
            visited.append(count)
    return index, distance


def _grid(vectors: pa.Array, scale: int, width: int | None = None) -> tuple[np.ndarray, list[np.ndarray] | np.ndarray]:
    """Which vectors are kept, and their whole components: a matrix of ``width`` columns, or a list of rows without it."""
    lengths = np.diff(vectors.offsets.to_numpy()) if vectors.null_count == 0 else vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # missing components become NaN
    with np.errstate(invalid="ignore"):
        fine = np.abs(flat) < LARGEST
    of = np.repeat(np.arange(len(lengths)), lengths)
    keep = np.bincount(of[~fine], minlength=len(lengths)) == 0
    if vectors.null_count:
        keep &= vectors.is_valid().to_numpy(zero_copy_only=False)
    whole = np.floor(np.where(fine, flat, 0) * scale).astype(np.int64)
    if width is None:
        return keep, np.split(whole, np.cumsum(lengths)[:-1]) if len(lengths) else []
    out = np.zeros((len(lengths), width), np.int64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = keep[of]
    out[of[inside], place[inside]] = whole[inside]
    return keep, out[keep]


@dataclass
class Codebooks:
    """For each part the entries, whole numbers, one row each."""

    entries: list[np.ndarray]
    scale: int

    @property
    def width(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, in decimal and joined by commas."""
        return hashlib.sha256(",".join(str(v) for e in self.entries for v in e.ravel().tolist()).encode()).hexdigest()

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, len(self.entries), axis=1)

    def assign(self, x: np.ndarray, changed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Entries and squared distances of the parts of rows ``x``; ``changed`` holds the transformed entries."""
        found = [nearest(transform(p), c) for p, c in zip(self.parts(x), changed, strict=True)]
        index = np.stack([i for i, _ in found], axis=1)
        error = sum((d // c.shape[1]).astype(object) for (_, d), c in zip(found, changed, strict=True))
        return index, error


def _vectors(df: DataFrame, vector_col: str, id_col: str, label: Column) -> DataFrame:
    return df.select(F.col(id_col).alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))


def start(df: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """Codebooks of the parts of the smallest ids' vectors, in one pass that also finds the longest vector."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = _grid(batch.column("v"), scale)
            chosen = np.flatnonzero(keep)
            ids = batch.column("vec_id").take(pa.array(chosen))
            yield pa.RecordBatch.from_arrays([ids, pa.array([rows[i] for i in chosen], pa.list_(pa.int64()))], ["vec_id", "v"])

    id_type = df.schema["vec_id"].dataType.simpleString()
    seen = Observation()
    rows = df.mapInArrow(kept, f"vec_id {id_type}, v array<bigint>").observe(seen, F.max(F.size("v")).alias("longest"))
    named = F.when(F.col("vec_id").isNull(), 1).otherwise(0)
    first = rows.orderBy(named, "vec_id", "v").limit(entries).collect()
    longest = seen.get["longest"] or 0
    width = parts * max(1, -(-longest // parts))
    first = [r.v for r in first if r.vec_id is not None]
    table = np.array([v + [0] * (width - len(v)) for v in first], np.int64).reshape(len(first), width)
    return Codebooks(np.split(table, parts, axis=1), scale)


def _moved(df: DataFrame, books: Codebooks) -> Codebooks:
    """One round: entries at the floored means of their parts; unused ones stay."""
    sent, width, many = df.sparkSession.sparkContext.broadcast(books), books.width, len(books.entries[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        changed = [transform(e) for e in held.entries]
        totals = [np.zeros((many, e.shape[1]), np.int64) for e in held.entries]
        counts, rows = np.zeros((len(totals), many), np.int64), 0

        def given() -> pa.RecordBatch:
            part, entry = np.nonzero(counts)
            values = [totals[p][e].tolist() for p, e in zip(part, entry, strict=True)]
            arrays = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(values, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "total"])

        for batch in batches:
            _, x = _grid(batch.column("v"), held.scale, width)
            if not len(x):
                continue
            index, _ = held.assign(x, changed)
            for p, values in enumerate(held.parts(x)):
                np.add.at(totals[p], index[:, p], values)
                counts[p] += np.bincount(index[:, p], minlength=many)
            rows += len(x)
            if rows > HELD:
                yield given()
                rows, counts[:] = 0, 0
                for t in totals:
                    t[:] = 0
        yield given()

    made = df.select("v").mapInArrow(sums, "part int, entry int, n long, total array<bigint>")
    each = made.select("part", "entry", "n", F.posexplode("total").alias("place", "x"))
    summed = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    entries = [e.copy() for e in books.entries]
    for r in summed.collect():  # as many as the codebooks have components
        entries[r.part][r.entry, r.place] = int(r.x) // r.n
    return Codebooks(entries, books.scale)


def train(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, vector_col: str = "embedding", id_col: str = "vec_id"
) -> Codebooks:
    """Codebooks of all vectors after ``rounds`` rounds; at most 256 entries, as a code has two hex digits for each part."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    settle(df.sparkSession)
    vectors = _vectors(df, vector_col, id_col, F.lit(None).cast("int"))
    books = start(vectors, parts, entries, scale)
    for _ in range(rounds if len(books.entries[0]) else 0):
        books = _moved(vectors, books)
    return books


def encode(df: DataFrame, books: Codebooks, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str | None = None) -> DataFrame:
    """vec_id, label (null without ``label_col``), code and error of every kept vector."""
    vectors = _vectors(df, vector_col, id_col, F.lit(None).cast("int") if label_col is None else F.col(label_col))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields[:2]) + ", code string, error long"
    if not len(books.entries[0]):
        return df.sparkSession.createDataFrame([], schema)
    sent, width = df.sparkSession.sparkContext.broadcast(books), books.width

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        changed = [transform(e) for e in held.entries]
        for batch in batches:
            keep, x = _grid(batch.column("v"), held.scale, width)
            if not len(x):
                continue
            index, error = held.assign(x, changed)
            text, digits = index.astype(np.uint8).tobytes().hex(), 2 * index.shape[1]
            codes = [text[i : i + digits] for i in range(0, len(text), digits)]
            chosen = pa.array(np.flatnonzero(keep))
            arrays = [batch.column("vec_id").take(chosen), batch.column("label").take(chosen), pa.array(codes, pa.string()), pa.array([min(e, _LONG) for e in error.tolist()], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(coded, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The rows of ``encode``, computed once, and the errors summed over equal labels, missing ones together."""
    coded = written(coded, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
