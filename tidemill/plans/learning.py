"""The weekly learning flow: features, recommendations, and vectors for new reviews."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import features, recommend
from tidemill.operators.similarity import embed_hashed
from tidemill.sinks import RunReport, append, replace_table
from tidemill.sources import is_ready, pending, read_layer


def refresh_recommendations(spark: SparkSession, root: str, now: datetime) -> RunReport | None:
    """Features from silver purchases, a model trained on all but the held-out pairs, and its top list per user.

    Does nothing while the purchases table is missing or empty. The stored table can be sent on with ``write_jdbc``.
    """
    if not is_ready(lambda: read_layer(spark, root, "silver", "purchases_enriched")):
        return None
    bought = read_layer(spark, root, "silver", "purchases_enriched")
    known = bought.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    replace_table(features.user_item_features(bought), root, "features", "user_item_interactions")
    replace_table(features.user_features(bought), root, "features", "user_features")
    replace_table(features.item_features(known), root, "features", "item_features")
    stored = read_layer(spark, root, "features", "user_item_interactions")
    train, test = recommend.train_test(recommend.ratings(stored.where("user_id is not null and item_id is not null")))
    model = recommend.fit_als(train)
    replace_table(recommend.rmse(model, test), root, "features", "model_quality")
    return replace_table(recommend.recommend_all(model, now), root, "serving", "user_recommendations")


def refresh_embeddings(spark: SparkSession, root: str, reviews: DataFrame) -> RunReport:
    """Add vectors for the reviews that have none yet; those already stored are not made again.

    Rarity weights are taken from all reviews, so vectors of one text made at different times differ slightly.
    """
    todo = reviews
    if is_ready(lambda: read_layer(spark, root, "serving", "review_vectors")):
        todo = pending(reviews, read_layer(spark, root, "serving", "review_vectors"), "review_id")
    return append(embed_hashed(todo, "review_id", "review", corpus=reviews), root, "serving", "review_vectors")
