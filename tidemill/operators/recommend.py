"""Item recommendations by implicit-feedback ALS, their evaluation, and serving."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions import stamp
from tidemill.operators.dedup import top_per_key
from tidemill.operators.factors import top_items
from tidemill.session import ensure_checkpoint_dir

BLOCK_RATINGS = 16_000_000  # rows of a block of users or items, about


def ratings(features: DataFrame) -> DataFrame:
    """(user_id int, item_id int, rating float): how often a user bought an item."""
    return features.select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), F.col("purchase_count").cast("float").alias("rating")
    )


def _bucket(seed: int) -> Column:
    """0..99, fixed by user, item and seed alone: eight hex digits of an MD5 sum, modulo 100."""
    text = F.concat_ws("-", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 100


def with_split(rated: DataFrame, seed: int = fixed.ALS_SEED, train_percent: int = fixed.ALS_TRAIN_PERCENT) -> DataFrame:
    """Adds ``is_train``. Unlike a random split this does not depend on how the rows are partitioned."""
    return rated.withColumn("is_train", _bucket(seed) < train_percent)


def train_test(rated: DataFrame, seed: int = fixed.ALS_SEED) -> tuple[DataFrame, DataFrame]:
    marked = with_split(rated, seed)
    return marked.where("is_train").drop("is_train"), marked.where(~F.col("is_train")).drop("is_train")


def fit_als(
    train: DataFrame,
    rank: int = fixed.ALS_RANK,
    iterations: int = fixed.ALS_ITERATIONS,
    reg: float = fixed.ALS_REG,
    seed: int = fixed.ALS_SEED,
    blocks: int | None = None,
) -> ALSModel:
    """Train on (user_id, item_id, rating). Lineage is cut in the shared checkpoint folder every five iterations.

    Each iteration sends a user's factors to every block of items that holds one of theirs, and back. So users and items are cut
    into few blocks: one for each core, or more where a block would have over ``BLOCK_RATINGS`` rows. ``train`` is read twice.
    """
    ensure_checkpoint_dir(train.sparkSession)
    blocks = blocks or max(train.sparkSession.sparkContext.defaultParallelism, math.ceil(train.count() / BLOCK_RATINGS))
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        implicitPrefs=True,
        coldStartStrategy="drop",
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=5,
    )
    return als.fit(train)


def flatten_recommendations(recommendations: DataFrame) -> DataFrame:
    """One row per user and recommended item out of an array of (item_id, rating)."""
    return recommendations.select("user_id", F.explode("recommendations").alias("rec")).select(
        "user_id", F.col("rec.item_id").alias("item_id"), F.col("rec.rating").alias("score")
    )


def recommend_all(
    model: ALSModel, now: datetime, k: int = fixed.RECOMMENDATIONS_PER_USER, version: str = fixed.ALS_MODEL_VERSION
) -> DataFrame:
    """The k best items of every user, with score, model version and time; exact, without scoring all pairs."""
    best, _ = top_items(model.userFactors, model.itemFactors, k)
    typed = best.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), F.col("score").cast("float"))
    return stamp(typed, version, now)


def rmse(model: ALSModel, test: DataFrame) -> DataFrame:
    """One row: root mean squared error of the predictions on held-out rows, and how many could be predicted.

    The model predicts a preference near 0..1 and the label is a purchase count, so this is large by design.
    """
    error = F.col("prediction").cast("double") - F.col("rating").cast("double")
    return model.transform(test).agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("predictions"))


def ranking_metrics(recs: DataFrame, held_out: DataFrame, k: int = fixed.RECOMMENDATIONS_PER_USER) -> DataFrame:
    """One row: mean precision@k and recall@k over the users with held-out items."""
    truth = held_out.select("user_id", "item_id").distinct()
    shown = recommend_for_users(recs, k).select("user_id", "item_id")
    hits = shown.join(truth, ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    per_user = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant")).join(hits, "user_id", "left")
    found = F.coalesce("hits", F.lit(0))
    return per_user.agg(
        F.avg(found / F.lit(k)).alias("precision_at_k"),
        F.avg(found / F.col("relevant")).alias("recall_at_k"),
        F.count(F.lit(1)).alias("users"),
    )


def recommend_for(recs: DataFrame, user_id: int, n: int = fixed.RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The n best items of one user, as a service asks for them."""
    best = recs.where(F.col("user_id") == user_id).orderBy(F.col("score").desc_nulls_last(), "item_id")
    return best.select("item_id", "score").limit(n)


def recommend_for_users(recs: DataFrame, n: int = fixed.RECOMMENDATIONS_PER_USER, users: DataFrame | None = None) -> DataFrame:
    """The n best items of every user, or of the listed users."""
    if users is not None:
        recs = recs.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return top_per_key(recs, ["user_id"], [F.col("score").desc_nulls_last(), F.col("item_id").asc()], n)
