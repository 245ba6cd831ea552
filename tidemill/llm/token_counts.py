"""Token counts from flat token files: a vectorised search for the end-of-document id, stitched across blocks by a prefix scan.

A flat token file is unsigned 16-bit ids one after another, each document ended by the separator, with no index. It is read as
blocks that are cut anywhere. A task searches its blocks for the separator with one vector comparison each and reports, for a
block, how many ids it has and where its documents end. A running sum over the blocks of a file then gives each block's place and
the end of the last document before it, so a document that spans blocks gets its count from the block in which it ends.

``flatten`` writes documents as such files, kept as rows (file, block, tokens) of a Parquet table so that writing is atomic and
can go to any store; ``scan_files`` reads plain binary files. Defined results: a null or empty text counts 0; ids after the last
separator of a file are a document without an end (``ended`` false); repeated rows count each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import settle, written
from tidemill.llm.tokens import END_OF_TEXT, default_path, tokenizer

BLOCK_IDS = 1 << 18
_BLOCK = "file string, block long, tokens binary, doc_ids array<bigint>"


def flatten(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    path: str | None = None,
    separator: int = END_OF_TEXT,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Rows (file, block, tokens, doc_ids): one file for each task; doc_ids are those of the documents that end in the block.

    Blocks have ``block_ids`` ids, whatever documents they cut; the last one of a file is shorter.
    """
    shared = tokenizer(docs.sparkSession, path or default_path())
    end = np.array([separator], "<u2").tobytes()

    def lay(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, file, size = shared.value().encode, f"part-{TaskContext.get().partitionId():06d}", 2 * block_ids
        held, ends, block, laid = bytearray(), [], 0, 0  # laid: bytes of the blocks already given out

        def give(whole: bool) -> pd.DataFrame:
            nonlocal held, ends, block, laid
            rows = []
            while held and (len(held) >= size or not whole):
                cut = bytes(held[:size])
                mine = [d for at, d in ends if at <= laid + len(cut)]
                rows.append((file, block, cut, mine))
                held, ends, block, laid = held[size:], ends[len(mine) :], block + 1, laid + len(cut)
            return pd.DataFrame(rows, columns=["file", "block", "tokens", "doc_ids"])

        for part in parts:
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                held += np.frombuffer(encode(text), "<u4").astype("<u2").tobytes() + end
                ends.append((laid + len(held), None if doc is None else int(doc)))
                if len(held) >= size:
                    yield give(True)
        yield give(False)

    # As text, because pandas has no long column with nulls.
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(lay, _BLOCK)


def read_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of plain binary token files; a file is read by one task, so files stay below a task's memory."""
    size = F.lit(2 * block_ids)
    files = spark.read.format("binaryFile").load(path)
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0))).cast("array<bigint>")
    return files.select(F.col("path").alias("file"), "content", F.explode(blocks).alias("block")).select(
        "file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), size).alias("tokens")
    )


def scan(blocks: DataFrame, separator: int = END_OF_TEXT) -> DataFrame:
    """(file, block, n_ids, ends): where documents end in each block, by one vector comparison for each block."""

    @F.pandas_udf("n_ids long, ends array<int>")
    def search(tokens: pd.Series) -> pd.DataFrame:
        ids = [np.frombuffer(t, "<u2") for t in tokens]
        return pd.DataFrame({"n_ids": [len(x) for x in ids], "ends": [np.flatnonzero(x == separator).astype(np.int32) for x in ids]})

    rest = [c for c in blocks.columns if c != "tokens"]
    return blocks.withColumn("_s", search("tokens")).select(*rest, "_s.n_ids", "_s.ends")


def stitch(scanned: DataFrame) -> DataFrame:
    """(file, start, n_tokens, ended, doc_id if known) of every document, from the blocks' summaries."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ended = F.when(F.size("ends") > 0, F.col("first") + F.element_at("ends", -1) + 1)
    placed = (
        scanned.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .withColumn("last_end", ended)
        .withColumn("carry", F.coalesce(F.max("last_end").over(before), F.lit(0)))  # where the open document began
        .withColumn("tail", F.count("block").over(after) == 0)
    )
    begin = F.when(F.col("k") > 0, F.col("first") + F.element_at("ends", F.greatest(F.col("k"), F.lit(1))) + 1).otherwise(F.col("carry"))
    known = F.get("doc_ids", F.col("k")) if "doc_ids" in scanned.columns else F.lit(None).cast("long")
    whole = placed.select("*", F.posexplode("ends").alias("k", "end")).select(
        "file", begin.alias("start"), (F.col("first") + F.col("end") - begin).alias("n_tokens"), F.lit(True).alias("ended"), known.alias("doc_id")
    )
    total, open_from = F.col("first") + F.col("n_ids"), F.coalesce("last_end", "carry")
    open_ = placed.where(F.col("tail") & (total > open_from)).select(
        "file", open_from.alias("start"), (total - open_from).alias("n_tokens"), F.lit(False).alias("ended"), F.lit(None).cast("long").alias("doc_id")
    )
    return whole.unionByName(open_)


def scan_files(spark: SparkSession, path: str, separator: int = END_OF_TEXT, block_ids: int = BLOCK_IDS) -> DataFrame:
    return stitch(scan(read_files(spark, path, block_ids), separator))


def count_tokens(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """Tokens of every document (doc_id, file, start, n_tokens), counted in the flat files that ``flatten`` writes."""
    settle(docs.sparkSession)
    blocks = written(flatten(docs, text_col, id_col, path), "tokens")
    return stitch(scan(blocks)).select("doc_id", "file", "start", "n_tokens")
