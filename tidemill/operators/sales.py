"""Sales aggregates: gold reports and the flash-sale dashboard.

Sums are partially aggregated before the shuffle, so an item or hour that holds a third of all rows costs its reducer
one row per map task. Top-k reports sort by measure and then id, which makes their result unique.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.clock import hour_start, last

_ITEM = ["item_id", "item_name", "item_category"]


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Total order of a small report; a leading ``-`` means descending."""
    return df.orderBy(*[F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns])


def top_selling_items(purchases: DataFrame, k: int = 10) -> DataFrame:
    """The k items with the most revenue, over all time."""
    revenue = purchases.groupBy(*_ITEM).agg(F.sum("total_price").alias("total_revenue"))
    return ordered(revenue, "-total_revenue", "item_id", "item_name", "item_category").limit(k)


def top_selling_daily(purchases: DataFrame, now: datetime, interval: str = "30 days") -> DataFrame:
    """Revenue per item and day of the trailing interval."""
    recent = last(purchases, "created_at", now, interval)
    return recent.groupBy(*_ITEM, "purchase_date").agg(F.sum("total_price").alias("total_revenue"))


def sales_24h(purchases: DataFrame, now: datetime) -> DataFrame:
    """Revenue by hour of day over the last 24 hours. The hour ``now`` falls into mixes today's and yesterday's sales."""
    recent = last(purchases, "created_at", now, "24 hours")
    return ordered(recent.groupBy("purchase_hour").agg(F.sum("total_price").alias("total_revenue")), "purchase_hour")


def pageviews_by_channel(views: DataFrame) -> DataFrame:
    return ordered(views.groupBy("channel").agg(F.count(F.lit(1)).alias("total_pageviews")), "-total_pageviews", "channel")


def channel_daily(views: DataFrame) -> DataFrame:
    """Views per channel and day."""
    return views.groupBy("channel", F.to_date("received_at").alias("view_date")).agg(
        F.count(F.lit(1)).alias("total_pageviews")
    )


def of_campaign(purchases: DataFrame, campaign_id: str | None) -> DataFrame:
    return purchases if campaign_id is None else purchases.where(F.col("campaign_id") == campaign_id)


def not_deleted(df: DataFrame) -> DataFrame:
    return df.where(~F.col("deleted"))


def hourly_volume(purchases: DataFrame, now: datetime, campaign_id: str | None = None) -> DataFrame:
    """Quantity sold per clock hour over the last 24 hours, without deleted purchases."""
    recent = of_campaign(not_deleted(last(purchases, "created_at", now, "24 hours")), campaign_id)
    hourly = recent.groupBy(hour_start(F.col("created_at")).alias("hour"))
    return ordered(hourly.agg(F.sum("quantity").alias("total_sales")), "hour")


def flash_top_items(purchases: DataFrame, k: int = 10, campaign_id: str | None = None) -> DataFrame:
    """The k items with the most revenue. Every row counts: all change versions, and deleted purchases too."""
    per_item = of_campaign(purchases, campaign_id).groupBy("item_id").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.col("quantity") * F.col("purchase_price")).alias("total_revenue"),
    )
    return ordered(per_item, "-total_revenue", "item_id").limit(k)


def revenue_by_category(purchases: DataFrame, items: DataFrame, now: datetime, interval: str = "24 hours") -> DataFrame:
    """Purchases and revenue per category of the current item table, over the trailing interval.

    Purchases are summed per item first; the join then carries one row per item instead of one per purchase.
    """
    recent = last(purchases, "created_at", now, interval, open_start=True)
    per_item = recent.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("purchase_price").alias("revenue")
    )
    joined = per_item.join(items.select(F.col("id").alias("item_id"), "category"), "item_id")
    per_category = joined.groupBy("category").agg(
        F.sum("n").alias("purchase_count"), F.sum("revenue").alias("total_revenue")
    )
    return ordered(per_category, "-total_revenue", "category")


def purchase_volume(purchases: DataFrame, now: datetime, interval: str = "1 hour") -> DataFrame:
    """One row: purchases and revenue of the trailing interval."""
    return last(purchases, "created_at", now, interval, open_start=True).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("purchase_price").alias("revenue")
    )


def item_sales(purchases: DataFrame, now: datetime, interval: str = "24 hours") -> DataFrame:
    """Purchases and revenue per item of the trailing interval."""
    recent = last(purchases, "created_at", now, interval, open_start=True)
    per_item = recent.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("purchase_price").alias("revenue")
    )
    return ordered(per_item, "-revenue", "item_id")


def recent_rows(df: DataFrame, k: int = 20, ts: str = "updated_at", key: str = "id") -> DataFrame:
    """The k rows updated last."""
    return ordered(df, f"-{ts}", f"-{key}").limit(k)


def join_live(report: DataFrame, live: DataFrame, key: str = "item_id", live_key: str = "id") -> DataFrame:
    """A gold report joined with the operational table as it is now."""
    current = live.select(F.col(live_key).alias(key), F.col("name").alias("live_name"))
    return report.join(current, key).select(*report.columns, "live_name")
