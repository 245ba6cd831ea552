"""Similarity join on word n-gram sets by Jaccard, and its connected components: a size-aware heavy-light join.

Texts become sets of 64-bit hashes of their shingles; equal sets are one class and are joined once. Sets up to a boundary size are
light: for every overlap that some partner's size would ask for they give out all their subsets of that size, so two linked light sets
share one. Larger sets are heavy: they are put into the inverted lists of their first ``n - least overlap + 1`` shingles in one order that
all sets share, so two linked sets meet in a list; light sets near the boundary go there too. The boundary is where the number of subsets
gives way to the cost of scanning lists, estimated from the counts of sizes and shingles. The order puts shingles that many texts have
last: a sketch of all shingles' counts, of a fixed size whatever the data's, tells them.

Lists are not expanded into all pairs. For components, first each set of a list meets the list's smallest set; the links found give
first components. Then only pairs of different components meet, so a list of copies of one text costs as many pairs as it has
members. A pair that shares many lists meets in few of them: each listing carries the set's ``BEFORE`` listings before it, and
two sets that have one of these in common have met there or earlier. Pairs
are tested against three exact bounds (sizes, places in the order, and parity sketches whose differing bits cannot outnumber the
sets' differing shingles) before the sets themselves are compared. Every link between different components is found, which is
what the components need. ``links`` skips the components and finds every link between different sets.

What is written on the way lies in one folder under the shared one, which is deleted when the result has been written.

Defined results: null or word-less texts have size 0, no links and their own id as component; texts of fewer than ``size`` words
are one shingle; repeated rows share a component; a component without any id is null. Two different sets are taken as
equal if their 64-bit hashes agree.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, columns, give_back, lean, settle, written

SIZE = 4
SLOT_BITS = 20
CHUNKS = 64
PARITY, WIDE = 8, 64  # longs of a parity sketch; the wide one is made of sets of at least WIDE_FROM shingles
WIDE_FROM = 1000
MOST_LIGHT = 64  # far beyond any boundary that cost can choose: sets of 64 have over 10^10 subsets of the size asked for
BEFORE = 8  # earlier listings that a listing carries
FILTER_BITS = 24
_CACHE = 50_000
_KEPT = 50_000  # class keys that a task remembers, to give each out once

_META = "doc_id long, n long, key long, parity array<bigint>, wide array<bigint>, chunk int, counts binary"
_INDEX = "key long, n int, tokens array<bigint>, places array<int>"


@dataclass(frozen=True)
class Threshold:
    """Sets are linked whose similarity is at least num / den."""

    num: int = 85
    den: int = 100


AT = Threshold()


def least_overlap(n: int, t: int, at: Threshold = AT) -> int:
    """Smallest intersection of sets of sizes n and t that are linked."""
    return -(-at.num * (n + t) // (at.num + at.den))


def least_partner(n: int, at: Threshold = AT) -> int:
    return -(-at.num * n // at.den)


def subset_sizes(n: int, at: Threshold = AT) -> list[int]:
    largest = at.den * n // at.num
    sizes = {least_overlap(n, t, at) for t in range(least_partner(n, at), largest + 1)}
    return sorted(c for c in sizes if c <= n and not (c == n and largest == n))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TURN = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Shingler:
    """Sorted distinct shingle hashes of a text; words' hashes are kept, at most ``_CACHE`` of them."""

    def __init__(self, size: int = SIZE) -> None:
        self.size, self.seen = size, {}
        self.turn = [_mix(np.array([k * 977 + 13], np.uint64))[0] | np.uint64(1) for k in range(1, size + 1)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.size:
            return np.array([xxhash.xxh64_intdigest(b"\0" + b" ".join(words))], np.uint64)
        seen = self.seen
        if len(seen) > _CACHE:
            seen.clear()
        try:
            codes = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in set(words):
                if w not in seen:
                    seen[w] = xxhash.xxh64_intdigest(w)
            codes = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        last = len(words) - self.size + 1
        mixed = np.zeros(last, np.uint64)
        for k, turn in enumerate(self.turn):
            mixed += codes[k : k + last] * turn
        return np.unique(_mix(mixed))


def key_of(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes()))))


def parity_of(shingles: np.ndarray, longs: int = PARITY) -> np.ndarray:
    bits = np.bincount((shingles & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _signatures(size: int):
    """A row for each text, then the task's shingle counts by slot, in chunks."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, names = Shingler(size), [c.split()[0] for c in _META.split(", ")]
        numbers = {"doc_id", "n", "key", "chunk"}
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for part in parts:
            rows, held = [], []
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                s = shingle(text)
                doc = None if doc is None else int(doc)
                wide = parity_of(s, WIDE) if len(s) >= WIDE_FROM else None
                rows.append((doc, len(s), key_of(s), parity_of(s), wide, None, None) if len(s) else (doc, 0, *[None] * 5))
                held.append(s)
            if held:
                slots = (np.concatenate(held) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                counts += np.bincount(slots, minlength=1 << SLOT_BITS)
            yield columns(rows, names, numbers)
        chunks = [(*[None] * 5, i, zlib.compress(c.tobytes(), 1)) for i, c in enumerate(np.split(counts, CHUNKS))]
        yield columns(chunks, names, numbers)

    return run


def _sum_chunk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in part["counts"])
    return pd.DataFrame({"chunk": [int(key[0])], "counts": [total.tobytes()]})


def shingle_counts(meta: DataFrame) -> np.ndarray:
    """Counts of all texts' shingles by slot: a fixed number of them."""
    rows = meta.where(F.col("chunk").isNotNull()).select("chunk", "counts").groupBy("chunk").applyInPandas(_sum_chunk, "chunk int, counts binary")
    by = {r.chunk: np.frombuffer(r["counts"], np.int64) for r in rows.collect()}
    return np.concatenate([by[i] for i in range(CHUNKS)]) if by else np.zeros(1 << SLOT_BITS, np.int64)


def frequency_levels(counts: np.ndarray) -> np.ndarray:
    """0 for slots as full as chance would have them, then 1 more for each doubling."""
    mean = counts.mean()
    usual = mean + 4 * math.sqrt(mean) + 4
    return np.floor(np.log2(np.maximum(counts / usual, 1))).astype(np.uint8) + (counts > usual).astype(np.uint8)


def light_boundary(sizes: dict[int, int], list_cost: float, at: Threshold = AT) -> int:
    """The size up to which enumerating subsets is cheaper than scanning lists."""
    light = {n: sum(math.comb(n, c) for c in subset_sizes(n, at)) for n in range(1, MOST_LIGHT + 1)}
    heavy = {n: (n - least_partner(n, at) + 1) * list_cost for n in light}

    def cost(b: int) -> float:
        both = {n for n in light if least_partner(b + 1, at) <= n <= b}
        return sum(sizes.get(n, 0) * ((light[n] if n <= b else 0) + (heavy[n] if n > b or n in both else 0)) for n in light)

    return min(range(MOST_LIGHT + 1), key=lambda b: (cost(b), b))


def tokens_of(shingles: np.ndarray, levels: np.ndarray, boundary: int, at: Threshold = AT) -> tuple[np.ndarray, np.ndarray]:
    """Tokens under which a set is listed, and each one's place in the order (-1 for a subset)."""
    n, tokens, places = len(shingles), [], []
    if n <= boundary:
        whole, values = int(shingles.sum(dtype=np.uint64)), [int(v) for v in shingles]
        sums = []
        for c in subset_sizes(n, at):
            for left in itertools.combinations(values, n - c):
                sums.append(((whole - sum(left)) * 0x9E3779B97F4A7C15 + c) & 0xFFFFFFFFFFFFFFFF)
        tokens.append(_mix(np.array(sums, np.uint64)))
        places.append(np.full(len(sums), -1, np.int32))
    if n > boundary or n >= least_partner(boundary + 1, at):
        first = n - least_partner(n, at) + 1
        order = np.lexsort((shingles, levels[(shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]))[:first]
        tokens.append(shingles[order])
        places.append(np.arange(first, dtype=np.int32))
    return np.concatenate(tokens).view(np.int64), np.concatenate(places)


def _listing(size: int, levels, boundary: int, at: Threshold):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, given = Shingler(size), {}
        for part in parts:
            rows = []
            for text in part["text"]:
                s = shingle(text)
                key = key_of(s) if len(s) else None
                if key is None or key in given:
                    continue
                if len(given) > _KEPT:
                    given.clear()
                given[key] = True
                rows.append((key, len(s), *tokens_of(s, levels.value, boundary, at)))
            yield pd.DataFrame(rows, columns=["key", "n", "tokens", "places"])

    return run


def _least(a: Column, b: Column, at: Threshold) -> Column:
    return F.ceil(at.num * (a + b) / F.lit(float(at.num + at.den)) - 1e-9)


def _possible(a: str, b: str, at: Threshold) -> Column:
    """Sizes and parity sketches of sets ``a`` and ``b`` allow a link."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    differing = sum((F.bit_count(F.get(f"{a}parity", F.lit(i)).bitwiseXOR(F.get(f"{b}parity", F.lit(i)))) for i in range(PARITY)), F.lit(0))
    near = (at.den * F.least(n_a, n_b) >= at.num * F.greatest(n_a, n_b)) & (differing <= n_a + n_b - 2 * _least(n_a, n_b, at))
    return near


def _possible_wide(a: str, b: str, at: Threshold) -> Column:
    """The same by the wide sketches, for pairs of large sets; those of the small one fill up."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    bits = F.zip_with(f"{a}wide", f"{b}wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    return F.coalesce(differing <= n_a + n_b - 2 * _least(n_a, n_b, at), F.lit(True))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, shingles binary) of the classes in ``wanted`` (key, doc_id).

    Texts are read where they lie; a bit table of fixed size, made of the wanted ids, keeps most others from being cut into shingles.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    bits = wanted.select(slot.alias("s")).groupBy(F.floor(F.col("s") / 32).cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pmod(s, 32) as int)))").alias("b")
    )
    found = bits.toPandas()
    words = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    words[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(words.astype(np.uint32))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, given = Shingler(size), {}
        for part in parts:
            at = part["slot"].to_numpy(np.int64)
            hit = (sent.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1
            rows = []
            for i in np.flatnonzero(hit):
                s = shingle(part["text"].iloc[i])
                key = key_of(s) if len(s) else None
                if key is not None and key not in given:
                    if len(given) > _KEPT:
                        given.clear()
                    given[key] = True
                    rows.append((key, s.tobytes()))
            yield pd.DataFrame(rows, columns=["key", "shingles"])

    made = docs.select(slot.cast("long").alias("slot"), "text").mapInPandas(lean(run), "key long, shingles binary")
    return made.join(wanted.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))


def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """How many shingles two sets share."""
    sets = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True)]
    shared = pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in sets], dtype="int64")
    give_back()
    return shared


def roots(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(key, root) of every linked key but the roots: the smallest key reachable, by alternating large and small stars."""
    scratch = scratch or Scratch(links.sparkSession, "stars")
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        edges = scratch.written(edges)
        # Same edges as a round ago: every edge leads from a key to its root.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.toDF("key", "root")
        before = state
        around = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.written(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.union(least.select("u", F.col("m").alias("v"))).distinct()


class _Join:
    """The classes of equal sets, their lists, and what candidates are tested with."""

    def __init__(self, docs: DataFrame, text_col: str, id_col: str, size: int, at: Threshold, scratch: Scratch) -> None:
        spark: SparkSession = settle(docs.sparkSession)
        self.size, self.at, self.scratch = size, at, scratch
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        named = self.docs.select(F.col("doc_id").cast("string"), "text")  # pandas has no long column with nulls
        meta = scratch.written(named.mapInPandas(lean(_signatures(size)), _META))
        self.rows = meta.where(F.col("chunk").isNull()).select("doc_id", "n", "key", "parity", "wide")
        self.classes = scratch.written(
            self.rows.where(F.col("key").isNotNull())
            .groupBy("key")
            .agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "parity", "wide")])
        )
        counts = shingle_counts(meta)
        levels = spark.sparkContext.broadcast(frequency_levels(counts))
        sizes = {r.n: r["count"] for r in self.classes.where(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()}
        list_cost = max(1.0, float((counts.astype(float) ** 2).sum() / max(1, counts.sum()) - counts.mean()))
        boundary = light_boundary(sizes, list_cost, at)
        listed = self.docs.select("text").mapInPandas(lean(_listing(size, levels, boundary, at)), _INDEX)
        once = listed.groupBy("key").agg(F.first(F.struct("n", "tokens", "places")).alias("s"))
        index = scratch.written(
            once.select("key", "s.n", F.posexplode("s.tokens").alias("i", "token"), "s.places").select("key", "n", "token", F.get("places", F.col("i")).alias("place"))
        )
        # Lists of one set alone link nothing.
        self.lists = index.groupBy("token").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).where("pivot <> last").select("token", "pivot")
        self.shared = scratch.written(index.join(self.lists, "token"))
        scratch.drop(index)
        self.ends = [self.classes.select("key", "n", "parity", "wide").toDF(s, f"{s}n", f"{s}parity", f"{s}wide") for s in ("a", "b")]

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sets are linked, with the sizes of their intersection and union."""
        pairs = self.scratch.written(pairs)
        ends = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        wanted = self.classes.join(ends, "key", "left_semi").select("key", "doc_id")
        sets = self.scratch.written(_sets(self.docs, wanted, self.size))
        both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        sizes = ((F.octet_length("x") + F.octet_length("y")) / 8).cast("long")
        counted = both.select("a", "b", F.pandas_udf(_common, "long")("x", "y").alias("n_common"), sizes.alias("n"))
        counted = counted.select("a", "b", "n_common", (F.col("n") - F.col("n_common")).alias("n_union"))
        found = self.scratch.written(counted.where(self.at.den * F.col("n_common") >= self.at.num * F.col("n_union")))
        self.scratch.drop(sets)
        return found

    def to_pivots(self) -> DataFrame:
        """Links of each list's members to its smallest key."""
        a, b = self.ends
        pairs = self.shared.where("key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
        possible = pairs.join(a, "a").join(b, "b").where(_possible("a", "b", self.at) & _possible_wide("a", "b", self.at))
        return self.verified(possible.select("a", "b"))

    def met(self, member: DataFrame) -> DataFrame:
        """Links among the members (token, key, label, place) of lists, between different labels only."""
        earlier = Window.partitionBy("key").orderBy("place", "token").rowsBetween(-BEFORE, -1)
        known = member.join(self.classes.select("key", "n", "parity"), "key").withColumn("earlier", F.collect_list("token").over(earlier))
        columns = ("token", "key", "label", "place", "n", "parity", "earlier")
        member = self.scratch.written(known.select(*columns))
        left, right = (member.toDF("token", s, *[f"{s}{c}" for c in columns[2:]]) for s in ("a", "b"))
        ahead = F.when(
            (F.col("aplace") >= 0) & (F.col("bplace") >= 0),
            F.least("aplace", "bplace") + 1 + F.least(F.col("an") - F.col("aplace") - 1, F.col("bn") - F.col("bplace") - 1),
        ).otherwise(F.least("an", "bn"))
        enough = ahead >= _least(F.col("an"), F.col("bn"), self.at)
        first = ~F.arrays_overlap("aearlier", "bearlier")  # else they have met before
        meet = left.join(right, "token").where((F.col("alabel") < F.col("blabel")) & enough & first & _possible("a", "b", self.at))
        a, b = self.ends
        pairs = meet.select("a", "b").distinct().join(a, "a").join(b, "b").where(_possible_wide("a", "b", self.at)).select("a", "b")
        return self.verified(pairs)


def components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SIZE, at: Threshold = AT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id linked, directly or not) of every row."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    join = _Join(docs, text_col, id_col, size, at, scratch)
    rows, classes = join.rows, join.classes
    first = join.to_pivots().select("a", "b")

    # Members of different components meet each other.
    stars = roots(first, scratch)
    member = join.shared.select("token", "key", "place").join(stars, "key", "left").withColumn("label", F.coalesce("root", "key"))
    mixed = member.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    second = join.met(member.join(mixed, "token", "left_semi").select("token", "key", "label", "place")).select("a", "b")

    joined = roots(first.union(second), scratch)
    grouped = joined.union(joined.select("root", "root").distinct()).toDF("key", "root").join(classes.select("key", "doc_id"), "key")
    smallest = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = grouped.join(smallest, "root").select("key", "component_id")
    named = classes.select("key", F.col("doc_id").alias("rep")).join(of, "key", "left").select("key", F.coalesce("component_id", "rep").alias("component_id"))
    linked = rows.where(F.col("key").isNotNull()).select("doc_id", "n", "key").join(named, "key").select("doc_id", "n", "component_id")
    alone = rows.where(F.col("key").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    found = written(linked.union(alone).withColumnRenamed("n", "n_shingles"), "components")
    scratch.drop()
    return found


def links(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SIZE, at: Threshold = AT) -> tuple[DataFrame, DataFrame]:
    """(class pairs, membership): every link between different sets as (class_a, class_b, n_common, n_union) with class_a < class_b,
    and of every row doc_id, n_shingles, class_id (rows of equal sets have one; null without words) and n_links, the number of
    other classes its set is linked with. Rows of one class are linked with each other without a pair that says so.
    """
    scratch = Scratch(docs.sparkSession, "links")
    join = _Join(docs, text_col, id_col, size, at, scratch)
    found = join.met(join.shared.select("token", "key", "place").withColumn("label", F.col("key")))
    pairs = written(found.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), "n_common", "n_union"), "links")
    ends = pairs.select(F.col("class_a").alias("key")).union(pairs.select("class_b")).groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    rows = join.rows.select("doc_id", F.col("n").alias("n_shingles"), "key").join(ends, "key", "left")
    member = written(rows.select("doc_id", "n_shingles", F.col("key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "links")
    scratch.drop()
    return pairs, member
