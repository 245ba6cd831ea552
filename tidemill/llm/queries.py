"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import alignment, byte_bpe, decontaminate, html_extract, jaccard, language, packing, quality, shards, token_counts, topk, toxicity, vector_codes
from tidemill.llm.common import held_out, settle, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with the SQL that must give the same rows if there is any."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if check is not None:
            CHECKS[run.__name__] = check.strip()
        return run

    return register


@query("""
    with c as (select vec_id, unnest(embedding) as x, unnest(range(len(embedding))) as i from embeddings),
    fine as (select vec_id from c group by vec_id having bool_and(x is not null and isfinite(x))),
    q as (select vec_id, i, floor(64 * cast(x as double)) as x from c where vec_id in (select vec_id from fine)),
    s as (select a.vec_id as query_id, b.vec_id, cast(sum(a.x * b.x) as bigint) as score from q a join q b on a.i = b.i
          where a.vec_id % 20 = 0 and a.vec_id <> b.vec_id group by all)
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from s qualify rank <= 20""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query()
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query()
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = shards.shard(table(spark, sf_dir, "documents"), shards=40)
    return laid.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    graded = toxicity.grade(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return graded.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "severity", "grade", "toxic")


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


@query()
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.train(vectors)
    coded = vector_codes.with_label_errors(vector_codes.encode(vectors, books, label_col="label"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query()
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = byte_bpe.Codec(settle(spark))
    done = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), codec), codec)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
