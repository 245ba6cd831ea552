"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over the whole corpus by external spills.

Each text, with a space before it, is cut into tokens by a byte-level BPE (side A) and by a piece model (side B). Byte offsets where
tokens of both end cut a text into groups; two tokens that share bytes are linked. How often an (A, B) id pair is linked is
counted over all documents, and each document learns how its own links rank.

Texts are cut before single spaces between other characters, where neither tokenizer joins anything; the chunks between them are aligned
once, many in one pass over offsets, and remembered. A task sums its documents' links to records (pair, document, links). Whenever it
holds ``flush`` chunks it spills a run: the pairs in B-major order with their sums, radix-partitioned into cells by a hash of the pair,
as zstd blocks, and the run's own records, also compressed. Runs lie in a table in the shared folder.

A cell's runs are merged by a heap that reads them block by block; equal pairs of all runs come out together, which gives
their count, and as a B id's pairs follow one another, its maximum in that cell. The counts are written in each run's own order. The maxima
of all cells are one number for each B id, bounded by the vocabulary, and sent to all tasks. At last each run meets its counts and adds
up, through its records, what its documents get. Only runs' sums travel to the cells, so neither a frequent pair nor a frequent
B id makes a cell large: it is one entry for each run. Cells are as many as give each about ``CELL_BYTES`` of text.

Defined results: a null or empty text, and one whose tokens' bytes differ from it on either side, has no tokens: zeros and an empty
groups string. Rows are counted one by one, so repeated rows, ids that are null or repeated, empty tables and other columns need
nothing; other columns are not carried.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settle, written

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FLUSH = 1_000_000  # chunks of a run
CELL_BYTES = 32 << 20
BLOCK = 8192  # pairs in a zstd block
STRETCH = 1_000_000  # letters that are cut into chunks at a time
LIMIT, LETTERS = 250_000, 16_000_000  # chunks, and letters of chunks, that a worker remembers
DOCS = 50_000  # documents of a run at most

_SPILL = "run long, cell int, pairs binary, body binary, sides binary, heads binary"
_COUNTS = "run long, cell int, counts binary, pairs binary"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_HEADS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_SPACE = re.compile(r"(?<=\S) (?=\S)")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)


def packed(values: np.ndarray) -> bytes:
    """64-bit integers as a zstd frame of their byte planes."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(frame: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _frames(frames: list[bytes]) -> bytes:
    return b"".join(len(f).to_bytes(8, "little") + f for f in frames)


def _split(blob: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(blob):
        size = int.from_bytes(blob[at : at + 8], "little")
        yield blob[at + 8 : at + 8 + size]
        at += 8 + size


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in pieces of about ``size`` letters, without the single spaces between them."""
    begin = 0
    while len(text) - begin > size and (cut := _SPACE.search(text, begin + size)):
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


class Aligner:
    """Aligned chunks by number: their links' pairs (B id << 32 | A id), their counts and their groups as text."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        from tidemill.llm.tokens import _byte_letters

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, vocab = _byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if i and re.search("[^▁]▁", piece):
                raise ValueError("the piece model joins letters across a space")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_size, self.b_size = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.a_text = np.array([f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))], object)
        self.b_text = np.array([f"{i}{end}" for end in ",;" for i in range(len(self.b_bytes))], object)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.letters, self.groups = 0, []
        self.counts, self.pairs, self.begins, self.good = array("q"), array("q"), array("q", [0]), array("b")

    def _learn(self, chunks: list[str]) -> None:
        whole = [" " + c for c in chunks]
        a = [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        for i, text in enumerate(whole):
            raw = text.encode("utf-8", "surrogatepass")
            good = b"".join(map(self.a_bytes.__getitem__, a[i])) == raw == b"".join(map(self.b_bytes.__getitem__, b[i]))
            self.good.append(good)
            if not good:
                a[i] = b[i] = []
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a_ids = np.fromiter(itertools.chain.from_iterable(a), np.int64, int(n_a.sum()))
        b_ids = np.fromiter(itertools.chain.from_iterable(b), np.int64, int(n_b.sum()))
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        ends = np.union1d(a_ends, b_ends)
        pairs = b_ids[np.searchsorted(b_ends, ends)] << 32 | a_ids[np.searchsorted(a_ends, ends)]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        lasts = np.concatenate([[0], a_ends])[np.cumsum(n_a)]  # where each chunk's bytes end
        links = np.diff(np.searchsorted(ends, lasts, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(common, lasts, "right"), prepend=0)

        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        b_before = np.concatenate([[0], np.searchsorted(b_ends, common, "right")])
        a_through = np.searchsorted(a_ends, common, "right")
        out = np.empty(len(a_ids) + len(b_ids), object)
        if len(common):
            out[np.arange(len(a_ids)) + b_before[a_group]] = self.a_text[a_ids + len(self.a_bytes) * (a_ends == common[a_group])]
            out[np.arange(len(b_ids)) + a_through[b_group]] = self.b_text[b_ids + len(self.b_bytes) * (b_ends == common[b_group])]
        tokens, at = out.tolist(), 0
        for chunk, n in zip(chunks, (n_a + n_b).tolist(), strict=True):
            self.known[chunk] = len(self.groups)
            self.groups.append("".join(tokens[at : at + n])[:-1].encode())
            self.letters += len(chunk)
            at += n
        self.counts.frombytes(np.stack([n_a, n_b, n_groups, links], axis=1).astype(np.int64).tobytes())
        self.begins.frombytes((self.begins[-1] + np.cumsum(links)).astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.astype(np.int64).tobytes())

    def _numbers(self, parts: list[list[str]]) -> list[np.ndarray]:
        unseen = [c for c in dict.fromkeys(itertools.chain.from_iterable(parts)) if c not in self.known]
        if unseen:
            self._learn(unseen)
        return [np.fromiter(map(self.known.__getitem__, p), np.int64, len(p)) for p in parts]

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The chunks' numbers of each text; none for a text without tokens."""
        good = lambda e: e if len(e) and np.frombuffer(self.good, np.int8)[e].all() else e[:0]
        waiting: list[list[str]] = []
        held = 0
        for text in texts:
            if len(text) > STRETCH:
                yield from map(good, self._numbers(waiting))
                waiting, held = [], 0
                yield good(np.concatenate([self._numbers([_SPACE.split(s)])[0] for s in stretches(text)]))
                continue
            waiting.append(_SPACE.split(text) if text else [])
            held += len(text)
            if held > STRETCH:
                yield from map(good, self._numbers(waiting))
                waiting, held = [], 0
        yield from map(good, self._numbers(waiting))

    def text_of(self, numbers: np.ndarray) -> bytes:
        return b";".join(map(self.groups.__getitem__, numbers.tolist()))


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker and pair of files."""
    return Aligner(a_path, b_path)


def cell_of(pairs: np.ndarray, cells: int) -> np.ndarray:
    x = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(cells)).astype(np.int64)


class _Run:
    """Documents whose links wait to be spilled."""

    def __init__(self) -> None:
        self.heads: list[tuple] = []
        self.numbers: list[np.ndarray] = []
        self.chunks = 0

    def add(self, known: Aligner, doc_id: int | None, numbers: np.ndarray) -> None:
        if len(numbers):
            counts = np.frombuffer(known.counts, np.int64).reshape(-1, 4)[numbers].sum(axis=0).tolist()
            self.heads.append((doc_id, *counts, hashlib.sha256(known.text_of(numbers)).hexdigest()))
        else:
            self.heads.append((doc_id, 0, 0, 0, 0, ""))
        self.numbers.append(numbers)
        self.chunks += len(numbers)

    def rows(self, known: Aligner, run: int, cells: int) -> pa.RecordBatch:
        """The run's own records, and for each cell its pairs in B-major order with their sums."""
        n = len(self.heads)
        doc = np.repeat(np.arange(n), [len(e) for e in self.numbers])
        chunk, times = np.unique(np.concatenate(self.numbers) * n + doc, return_counts=True)
        chunk, doc = chunk // n, chunk % n
        begins = np.frombuffer(known.begins, np.int64)
        sizes = begins[chunk + 1] - begins[chunk]
        of = np.repeat(np.arange(len(chunk)), sizes)
        places = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[chunk][of]
        pairs, at = np.unique(np.frombuffer(known.pairs, np.int64)[places], return_inverse=True)
        cell = cell_of(pairs, cells)
        order = np.lexsort((pairs, cell))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        record = rank[at] * n + doc[of]
        by = np.argsort(record, kind="stable")
        record, times = record[by], times[of][by]
        first = np.flatnonzero(np.diff(record, prepend=-1))
        times = np.add.reduceat(times, first) if len(first) else times
        record = record[first]
        pairs, cell = pairs[order], cell[order]
        starts = np.searchsorted(record // max(1, n), np.arange(len(pairs)))
        sums = np.add.reduceat(times, starts) if len(pairs) else times

        found = np.unique(cell)
        edges = np.searchsorted(cell, np.append(found, cells))
        blobs = []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            blocks = [(pairs[i : min(i + BLOCK, end)], sums[i : min(i + BLOCK, end)]) for i in range(begin, end, BLOCK)]
            blobs.append(_frames([f for p, s in blocks for f in (packed(np.diff(p, prepend=0)), packed(s))]))
        heads = {c: [h[i] for h in self.heads] for i, c in enumerate(_HEADS)}
        own = pa.RecordBatch.from_pydict(heads, pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in _HEADS]))
        rest = [None] * len(blobs)
        columns = [
            pa.array([run] * (len(blobs) + 1), pa.int64()),
            pa.array([*found.tolist(), None], pa.int32()),
            pa.array([*blobs, None], pa.binary()),
            pa.array([*rest, _frames([packed(np.diff(record, prepend=0)), packed(times)])], pa.binary()),
            pa.array([*rest, packed(np.diff(pairs >> 32, prepend=0))], pa.binary()),
            pa.array([*rest, zstandard.compress(own.serialize(), 3)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SPILL.split(", ")])


def _spilling(paths: tuple[str, str], cells: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, made, held = aligner(*paths), TaskContext.get().partitionId() << 32, 0, _Run()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, numbers in zip(batch.column("doc_id").to_pylist(), known(texts), strict=True):
                held.add(known, doc_id, numbers)
                if held.chunks >= flush or len(held.heads) >= DOCS:
                    yield held.rows(known, base + made, cells)
                    made, held = made + 1, _Run()
            # Waiting documents refer to chunks by number, so chunks are forgotten only between runs.
            if len(known.groups) > LIMIT or known.letters > LETTERS:
                if held.heads:
                    yield held.rows(known, base + made, cells)
                    made, held = made + 1, _Run()
                known.forget()
        if held.heads:
            yield held.rows(known, base + made, cells)
        known.forget()

    return run


def spill(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None, flush: int = FLUSH, cells: int | None = None) -> DataFrame:
    """The runs of all documents, as a table in the shared folder."""
    spark = settle(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if cells is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CELL_BYTES))
    return written(docs.mapInArrow(_spilling(paths or default_paths(), cells, flush), _SPILL), "spill")


def _read(run: int, blob: bytes) -> Iterator[tuple[int, int, int]]:
    """(pair, run, links) of a cell's part of a run, a block at a time."""
    frames = _split(blob)
    for pairs, sums in zip(frames, frames, strict=True):
        for pair, n in zip(np.cumsum(unpacked(pairs)).tolist(), unpacked(sums).tolist(), strict=True):
            yield pair, run, n


def _merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """The counts of a cell's pairs, in the order of each of its runs, and the pairs with their counts."""
    counts = [array("q") for _ in part["run"]]
    pairs, totals = array("q"), array("q")
    merged = heapq.merge(*[_read(i, blob) for i, blob in enumerate(part["pairs"])])
    for pair, same in itertools.groupby(merged, key=lambda entry: entry[0]):
        members = [(run, n) for _, run, n in same]
        total = sum(n for _, n in members)
        pairs.append(pair)
        totals.append(total)
        for run, _ in members:
            counts[run].append(total)
    own = _frames([packed(np.diff(np.frombuffer(pairs, np.int64), prepend=0)), packed(np.frombuffer(totals, np.int64))])
    rows = [(int(run), int(key[0]), packed(np.frombuffer(c, np.int64)), None) for run, c in zip(part["run"], counts, strict=True)]
    return pd.DataFrame([*rows, (-1, int(key[0]), None, own)], columns=["run", "cell", "counts", "pairs"])


def merge(spilled: DataFrame) -> DataFrame:
    """For each run and cell the corpus-wide counts of its pairs; for each cell (run -1) all its pairs and their counts."""
    cells = spilled.where(F.col("cell").isNotNull()).select("run", "cell", "pairs")
    return written(cells.groupBy("cell").applyInPandas(_merge, _COUNTS), "counts")


def pair_counts(merged: DataFrame) -> DataFrame:
    """a_id, b_id and n_links of every linked id pair of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("pairs").to_pylist():
                pairs, totals = (unpacked(f) for f in _split(blob))
                pairs = np.cumsum(pairs)
                for at in range(0, len(pairs), 100_000):
                    cut = slice(at, at + 100_000)
                    arrays = [pa.array((pairs[cut] & 0xFFFFFFFF).astype(np.int32)), pa.array((pairs[cut] >> 32).astype(np.int32)), pa.array(totals[cut])]
                    yield pa.RecordBatch.from_arrays(arrays, ["a_id", "b_id", "n_links"])

    return merged.where("run = -1").select("pairs").mapInArrow(run, "a_id int, b_id int, n_links long")


def _contributions(tops: np.ndarray):
    """What the documents of a run get: one run's own row, and its counts of all cells."""

    def run(key: tuple, own: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        heads = pa.ipc.read_record_batch(zstandard.decompress(own["heads"].iloc[0]), pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in _HEADS]))
        n = heads.num_rows
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(counted):
            counts = np.concatenate([unpacked(c) for c in counted.sort_values("cell")["counts"]])
            is_top = counts == tops.value[np.cumsum(unpacked(own["sides"].iloc[0]))]
            record, times = (unpacked(f) for f in _split(own["body"].iloc[0]))
            rank, doc = np.divmod(np.cumsum(record), n)
            np.add.at(total, doc, times * counts[rank])
            np.add.at(best, doc, times * is_top[rank])
        frame = heads.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        return frame.assign(n_best=best, count_sum=total)[[c.split()[0] for c in _RESULT.split(", ")]]

    return run


def align(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None, flush: int = FLUSH, cells: int | None = None) -> DataFrame:
    """Each row's doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 ('' without tokens)."""
    spark = docs.sparkSession
    spilled = spill(docs, text_col, id_col, paths, flush, cells)
    merged = merge(spilled)
    # One number for each B id: bounded by the vocabulary.
    found = pair_counts(merged).groupBy("b_id").agg(F.max("n_links").alias("top")).collect()
    tops = np.zeros(max((r.b_id for r in found), default=0) + 1, np.int64)
    for r in found:
        tops[r.b_id] = r.top
    own = spilled.where(F.col("cell").isNull()).select("run", "body", "sides", "heads").groupBy("run")
    counted = merged.where("run >= 0").select("run", "cell", "counts").groupBy("run")
    return own.cogroup(counted).applyInPandas(_contributions(spark.sparkContext.broadcast(tops)), _RESULT)


def groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and the groups of every row as text, ``a1,a2|b1;a3|b2,b3`` with A and B ids in order."""
    settle(docs.sparkSession)
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(*paths)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [known.text_of(e).decode() for e in known(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "groups"])
            known.forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, groups string")
