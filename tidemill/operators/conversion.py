"""The purchase funnel: which viewed items get bought by the same user on the same day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import safe_ratio
from tidemill.operators.sales import ordered

_ITEM = ["item_id", "item_name", "item_category"]


def conversion(views: DataFrame, purchases: DataFrame, distinct_views: bool = False) -> DataFrame:
    """Users, purchases, views and conversion rate per viewed item.

    A view is matched with each purchase of that item by that user on that day, and the totals count matched pairs, so a
    user with 3 views and 2 purchases adds 6 to both. ``distinct_views`` counts 3 views and 2 purchases instead.

    The pairs are never formed. Both sides are counted per (item, user, day) first; a pair count is then the product of
    two counts. Distinct users fall out of a second grouping by (item, user), so no key is wider than one user's rows
    when a hot item is reduced.
    """
    viewed = views.groupBy(*_ITEM, "user_id", F.to_date("received_at").alias("on_day")).agg(
        F.count(F.lit(1)).alias("v")
    )
    bought = purchases.groupBy("item_id", "user_id", F.col("purchase_date").alias("on_day")).agg(
        F.count(F.lit(1)).alias("p_rows"), F.count("id").alias("p_ids")
    )
    pairs = viewed.join(bought, ["item_id", "user_id", "on_day"], "left")
    known = F.col("user_id").isNotNull()
    p_rows, p_ids = F.coalesce("p_rows", F.lit(0)), F.coalesce("p_ids", F.lit(0))
    views_counted = F.col("v") if distinct_views else F.col("v") * F.greatest(p_rows, F.lit(1))
    bought_counted = p_ids if distinct_views else F.col("v") * p_ids
    per_user = pairs.groupBy(*_ITEM, "user_id").agg(
        F.sum(F.when(known, views_counted).otherwise(0)).alias("v"),
        F.sum(bought_counted).alias("p"),
        F.max(p_rows > 0).alias("buyer"),
    )
    per_item = per_user.groupBy(*_ITEM).agg(
        F.count("user_id").alias("unique_pageview_users"),
        F.count_if(F.col("buyer") & known).alias("unique_purchase_users"),
        F.sum("p").alias("total_purchases"),
        F.sum("v").alias("total_pageviews"),
    )
    return per_item.withColumn("conversion_rate", safe_ratio(F.col("total_purchases"), F.col("total_pageviews")))


def top_converting_items(views: DataFrame, purchases: DataFrame, k: int = 10, distinct_views: bool = False) -> DataFrame:
    rates = conversion(views, purchases, distinct_views)
    return ordered(rates, "-conversion_rate", "item_id", "item_name", "item_category").limit(k)
