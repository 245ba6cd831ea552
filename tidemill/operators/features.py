"""Features for the recommender and for reports. Each is one partially aggregated grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import safe_ratio


def user_item_features(purchases: DataFrame) -> DataFrame:
    """How often, how much and at what average price each user bought each item."""
    return purchases.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_price").alias("total_spent"),
        F.avg("purchase_price").alias("avg_price"),
    )


def user_features(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_price").alias("lifetime_value"),
        F.avg("total_price").alias("avg_order_value"),
    )


def _category_counts(purchases: DataFrame, *keys: str) -> DataFrame:
    return purchases.groupBy(*keys, "item_category").agg(F.count(F.lit(1)).alias("purchases"))


def item_features(purchases: DataFrame) -> DataFrame:
    """Purchases per item, and what share of its category's purchases that is.

    Categories are summed from the per-item rows and joined back rather than windowed, so that a category holding most
    items is not one task.
    """
    per_item = purchases.groupBy("item_id", "item_category").agg(F.count(F.lit(1)).alias("purchase_count"))
    per_category = per_item.groupBy("item_category").agg(F.sum("purchase_count").alias("category_popularity"))
    joined = per_item.join(
        per_category.withColumnRenamed("item_category", "__category"),
        F.col("item_category").eqNullSafe(F.col("__category")),
        "left",
    ).drop("__category")
    return joined.withColumn("category_share", safe_ratio(F.col("purchase_count"), F.col("category_popularity")))


def category_affinity(purchases: DataFrame) -> DataFrame:
    """Share of each user's purchases per category. The window sees one row per user and category."""
    counts = _category_counts(purchases, "user_id")
    total = F.sum("purchases").over(Window.partitionBy("user_id"))
    return counts.withColumn("affinity", safe_ratio(F.col("purchases"), total))
