"""Byte-level BPE encoding and decoding by a rank file, with a two-tier lookup.

The pattern cuts a text into pre-tokens. The first tier is a minimal perfect hash over the vocabulary: a key's hash names a bucket,
the bucket's displacement sends the key to its own slot, and the slot's bytes are compared, so a pre-token that is a token
itself is found whole. What is not found goes to the second tier: its bytes form a linked list, a heap holds the adjacent pairs
whose joined bytes are a token by (rank, place), and the least one is merged until none is left. The hash answers that tier's
questions too. Pre-tokens of at most ``SHORT`` bytes, nearly all, are merged many at once instead: rows of ids, of which each loses its
leftmost pair of least rank in a round; a sorted table of the pairs of ids that make a token answers. Tables are built once on the
driver and broadcast; their size is the vocabulary's.

Long texts are cut into stretches before white space that follows something else, where no pre-token goes on, so that a text's
pre-tokens are never held at once; the unknown pre-tokens of about ``GATHER`` letters are resolved together. Resolved pre-tokens are remembered, at most ``LIMIT`` of them in a worker.

Defined results: null and empty texts have no ids and decode to no bytes; special tokens' strings are ordinary text; rows are
independent, so repeated rows, ids that are null and empty tables need nothing; other columns are not carried. Null ids
decode to no bytes. An id that the vocabulary lacks stops the decoding with its number.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANKS = "byte_bpe_multi_50k.tiktoken"
PER_BUCKET = 4
STRETCH = 200_000  # letters of a text that are cut into pre-tokens at a time
GATHER = 1_000_000
SHORT = 64
ROWS = 8192  # pre-tokens that are merged at once
LIMIT = 300_000
LONGEST_KEPT = 200  # letters of the longest pre-token that is remembered

_M64 = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15
_BREAK = regex.compile(r"\S(?=\s)")


def default_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _spread(hashes: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each hash under its displacement."""
    x = hashes + displacement * np.uint64(_STEP)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(slots)).astype(np.int64)


@dataclass
class PerfectHash:
    """Keys at their slots, and a displacement for each bucket; a negative one names the only key's slot (-1 - slot)."""

    keys: list[bytes]
    values: np.ndarray
    displacements: np.ndarray

    def __post_init__(self) -> None:
        self.listed, self.ranks = self.displacements.tolist(), self.values.tolist()  # for single keys

    @classmethod
    def of(cls, table: dict[bytes, int]) -> PerfectHash:
        """As many slots as keys. Big buckets choose first; those of one key take what is left."""
        keys, n = list(table), len(table)
        values = np.fromiter(table.values(), np.int64, n)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, n)
        if len(np.unique(hashes)) < n:
            raise ValueError("two keys of the vocabulary have one 64-bit hash")
        buckets = max(1, n // PER_BUCKET)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begins = np.searchsorted(bucket[order], np.arange(buckets + 1))
        sizes = np.diff(begins)
        taken, at, displacements = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(buckets, np.int64)
        tries = np.arange(32, dtype=np.uint64)[:, None]
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            members, base = order[begins[b] : begins[b + 1]], 0
            while True:
                slots = np.sort(_spread(hashes[members][None, :], tries + np.uint64(base), n), axis=1)
                good = ~taken[slots].any(1) & (np.diff(slots, axis=1) > 0).all(1)
                if good.any():
                    break
                base += len(tries)
            displacements[b] = base + int(np.argmax(good))
            at[members] = _spread(hashes[members], np.full(sizes[b], displacements[b], np.uint64), n)
            taken[at[members]] = True
        single = np.flatnonzero(sizes == 1)
        at[order[begins[single]]] = np.flatnonzero(~taken)
        displacements[single] = -1 - at[order[begins[single]]]
        placed = np.argsort(at)
        return cls([keys[i] for i in placed], values[placed], displacements)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot that each key would have; whether it is there shows by comparing."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        d = self.displacements[(hashes % np.uint64(len(self.displacements))).astype(np.int64)]
        return np.where(d < 0, -1 - d, _spread(hashes, np.maximum(d, 0).astype(np.uint64), len(self.keys)))

    def find(self, key: bytes) -> int:
        """One key's value, -1 if it is not there."""
        h = xxhash.xxh64_intdigest(key)
        d = self.listed[h % len(self.listed)]
        if d < 0:
            slot = -1 - d
        else:
            x = (h + d * _STEP) & _M64
            x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _M64
            slot = (x ^ (x >> 32)) % len(self.keys)
        return self.ranks[slot] if self.keys[slot] == key else -1


def merge(piece: bytes, find, single: list[int]) -> list[int]:
    """Ids of a piece: always the pair of least rank first, of equal ones the leftmost. ``find`` gives -1 for no token."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part's end is the next part's place
    part = [single[b] for b in piece]
    pair = [find(piece[i : i + 2]) for i in range(n - 1)]  # rank of the part at i joined with the next
    pair.append(-1)
    heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        rank, i = entry >> 32, entry & 0xFFFFFFFF
        if pair[i] != rank:  # merged or changed since
            continue
        middle = after[i]
        after[i] = end = after[middle]
        part[i], pair[middle], pair[i] = rank, -1, -1
        if end < n:
            before[end] = i
            pair[i] = rank = find(piece[i : after[end]])
            if rank >= 0:
                heapq.heappush(heap, rank << 32 | i)
        left = before[i]
        if left >= 0:
            pair[left] = rank = find(piece[left:end])
            if rank >= 0:
                heapq.heappush(heap, rank << 32 | left)
    ids, i = [], 0
    while i < n:
        ids.append(part[i])
        i = after[i]
    return ids


_NONE = np.iinfo(np.int32).max


class Pairs:
    """The ranks of tokens by pairs of ids whose bytes they join."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        cut = [(ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        cut.sort()
        self.keys, self.ranks = np.array([k for k, _ in cut] + [_NONE << 32], np.int64), np.array([r for _, r in cut] + [_NONE], np.int32)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.whole = bool(self.single.min() >= 0)  # else ids do not tell the bytes

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``_NONE`` for no token."""
        asked = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of at least two bytes as 32-bit bytes: of each piece the pair of least rank first, of equal ones the leftmost."""
        found: list[bytes] = [b""] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        for begin in range(0, len(order), ROWS):
            self._merge([pieces[i] for i in order[begin : begin + ROWS]], order[begin : begin + ROWS], found)
        return found

    def _merge(self, pieces: list[bytes], places: list[int], found: list[bytes]) -> None:
        left, place = np.array([len(p) for p in pieces]), np.array(places)
        inside = np.arange(left.max()) < left[:, None]
        ids = np.zeros(inside.shape, np.int32)
        ids[inside] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        pair = np.where(inside[:, 1:], self.find(ids[:, :-1], ids[:, 1:]), _NONE)
        while len(ids):
            row = np.arange(len(ids))
            at = pair.argmin(1) if pair.shape[1] else np.zeros(len(ids), int)
            least = pair[row, at] if pair.shape[1] else np.full(len(ids), _NONE)
            done = least == _NONE
            if done.any():
                raw, ends = ids[done][np.arange(ids.shape[1]) < left[done][:, None]].astype("<u4").tobytes(), (4 * np.cumsum(left[done])).tolist()
                for p, first, end in zip(place[done].tolist(), [0, *ends], ends, strict=False):
                    found[p] = raw[first:end]
                ids, pair, left, place, at, least = (x[~done] for x in (ids, pair, left, place, at, least))
                row = np.arange(len(ids))
            # Every row that is left loses one id and one pair.
            ids[row, at] = least
            kept = np.ones(ids.shape, bool)
            kept[row, at + 1] = False
            ids = ids[kept].reshape(len(ids), -1) if len(ids) else ids
            kept = np.ones(pair.shape, bool)
            kept[row, at] = False
            pair = pair[kept].reshape(len(ids), -1) if len(ids) else pair
            left = left - 1
            for second in (at + 1, at):
                r = row[(second > 0) & (second < left)]
                s = second[r]
                pair[r, s - 1] = self.find(ids[r, s - 1], ids[r, s])


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in pieces of about ``size`` letters that no pre-token crosses."""
    begin = 0
    while len(text) - begin > size and (cut := _BREAK.search(text, begin + size)):
        yield text[begin : cut.end()]
        begin = cut.end()
    yield text[begin:]


class _Asked(dict):
    """What the second tier asked the hash for."""

    def __init__(self, table: PerfectHash) -> None:
        super().__init__()
        self.table = table

    def __missing__(self, key: bytes) -> int:
        self[key] = rank = self.table.find(key)
        return rank


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, by a perfect hash and a pattern."""

    def __init__(self, table: PerfectHash, pattern: str, limit: int = LIMIT, pairs: Pairs | None = None) -> None:
        self.table, self.cut, self.limit = table, regex.compile(pattern), limit
        self.pairs = pairs or Pairs(dict(zip(table.keys, table.ranks, strict=True)))
        self.known: dict[str, bytes] = {}
        self.joined = _Asked(table)
        self.single = [table.find(bytes([b])) for b in range(256)]

    def resolve(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: whole ones by the hash, the rest by merging."""
        if len(self.joined) > self.limit:
            self.joined.clear()
        keys = [p.encode("utf-8", "replace") for p in parts]
        slots, table = self.table.slots(keys), self.table
        ids = table.values[slots].astype("<u4").tobytes()
        found, short = {}, {}
        for i, (part, key, slot) in enumerate(zip(parts, keys, slots.tolist(), strict=True)):
            if table.keys[slot] == key:
                found[part] = ids[4 * i : 4 * i + 4]
            elif 2 <= len(key) <= SHORT and self.pairs.whole:
                short[part] = key
            else:
                merged = merge(key, self.joined.__getitem__, self.single)
                found[part] = struct.pack(f"<{len(merged)}I", *merged)
        found.update(zip(short, self.pairs.merge(list(short.values())), strict=True))
        return found

    def many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        held: list[list[str] | None] = []  # pre-tokens of stretches; None ends a text
        letters, begun = 0, []
        for text in texts:
            for stretch in stretches(text or ""):
                held.append(self.cut.findall(stretch))
                letters += len(stretch)
                if letters >= GATHER:
                    yield from self._ids(held, begun)
                    held, letters = [], 0
            held.append(None)
        yield from self._ids(held, begun)

    def _ids(self, held: list[list[str] | None], begun: list[bytes]) -> list[bytes]:
        """Ids of the texts that end in ``held``; those of a text that does not end yet stay in ``begun``."""
        known, done = self.known, []
        if len(known) > self.limit:
            known.clear()
        new = set().union(*[parts for parts in held if parts is not None]).difference(known)
        known.update(self.resolve(list(new)))
        for parts in held:
            if parts is not None:
                begun.append(b"".join(map(known.__getitem__, parts)))
            else:
                done.append(b"".join(begun))
                begun.clear()
        for p in new:
            if len(p) > LONGEST_KEPT:
                del known[p]
        return done

    def __call__(self, text: str | None) -> bytes:
        return next(self.many([text]))


class Codec:
    """Columns of ids from texts and of bytes from ids, for one rank file."""

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str | None = None) -> None:
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        ranks = read_ranks(path or default_path())
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        shared = spark.sparkContext.broadcast((PerfectHash.of(ranks), tokens, pattern, Pairs(ranks)))

        def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            table, _, cut, pairs = shared.value
            encoder = Encoder(table, cut, pairs=pairs)
            for part in parts:
                yield pd.Series(list(encoder.many(part)), dtype=object)

        def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            of = shared.value[1]
            for part in parts:
                yield pd.Series([bytes_of(ids, of) for ids in part], dtype=object)

        # Marked as not to be repeated: a query that uses the ids twice encodes once.
        self.ids = F.pandas_udf(encoded, "binary").asNondeterministic()
        self.bytes = F.pandas_udf(decoded, "binary").asNondeterministic()


def bytes_of(ids: bytes | None, tokens: list[bytes]) -> bytes:
    found = np.frombuffer(ids or b"", "<u4")
    if len(found) and (found.max() >= len(tokens)):
        raise ValueError(f"no token has the id {found.max()}")
    return b"".join(map(tokens.__getitem__, found.tolist()))


def encode(docs: DataFrame, codec: Codec, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers, as flat token files have them) of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), codec.ids(F.col(text_col)).alias("ids"))


def decode(encoded: DataFrame, codec: Codec) -> DataFrame:
    """The rows of ``encode`` with their bytes as ``decoded``."""
    return encoded.withColumn("decoded", codec.bytes(F.col("ids")))
