"""User segments by activity, and recency / frequency / value cohorts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import days_since, engagement_segment


def engagement(users: DataFrame, views: DataFrame, now: datetime) -> DataFrame:
    """Views, active days and segment of every user with a valid e-mail, the never active included.

    Views are reduced to one row per user before the join, by way of (user, day), which also makes active days a plain
    count. Users listed more than once under the same e-mail and name count their views once per listing.
    """
    listed = (
        users.where(F.col("valid_email"))
        .groupBy(F.col("id").alias("user_id"), "email", "full_name")
        .agg(F.count(F.lit(1)).alias("listings"))
    )
    daily = views.groupBy("user_id", F.to_date("received_at").alias("on_day")).agg(F.count("page").alias("v"))
    active = daily.groupBy("user_id").agg(
        F.sum("v").alias("v"), F.count("on_day").alias("days"), F.max("on_day").alias("last_day")
    )
    idle = days_since(F.col("last_active_date"), now)
    return (
        listed.join(active, "user_id", "left")
        .select(
            "user_id",
            "email",
            "full_name",
            F.coalesce(F.col("listings") * F.col("v"), F.lit(0)).alias("total_pageviews"),
            F.coalesce("days", F.lit(0)).alias("active_days"),
            F.col("last_day").alias("last_active_date"),
        )
        .withColumn("days_since_last_active", idle)
        .withColumn("engagement_segment", engagement_segment(F.col("total_pageviews"), F.col("days_since_last_active")))
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("engagement_segment").agg(F.count(F.lit(1)).alias("users"))


@dataclass(frozen=True)
class Cohorts:
    """Limits of the four cohorts, in days, purchases and money. They are ours; override as needed."""

    recent_days: int = 7
    idle_days: int = 14
    new_days: int = 7
    champion_orders: int = 3
    champion_value: float = 100.0


def rfv_cohorts(users: DataFrame, views: DataFrame, purchases: DataFrame, now: datetime, limits: Cohorts = Cohorts()) -> DataFrame:
    """Each user's recency, frequency and value, and one of four cohorts.

    Champion: active lately, with enough orders and money spent. New: signed up lately and no champion. Inactive: not
    seen for longer than ``idle_days``, or never. At-Risk: all others.
    """
    seen = views.groupBy("user_id").agg(F.max(F.to_date("received_at")).alias("last_view"))
    spent = purchases.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_price").alias("value"), F.max("purchase_date").alias("last_order")
    )
    facts = (
        users.select(F.col("id").alias("user_id"), "created_at")
        .join(seen, "user_id", "left")
        .join(spent, "user_id", "left")
        .select(
            "user_id",
            days_since(F.greatest("last_view", "last_order"), now).alias("recency_days"),
            F.coalesce("orders", F.lit(0)).alias("frequency"),
            F.coalesce("value", F.lit(0)).cast("decimal(24,2)").alias("value"),
            days_since(F.to_date("created_at"), now).alias("age_days"),
        )
    )
    recency = F.col("recency_days")
    champion = (
        (recency <= limits.recent_days)
        & (F.col("frequency") >= limits.champion_orders)
        & (F.col("value") >= limits.champion_value)
    )
    cohort = (
        F.when(champion, "Champion")
        .when(F.col("age_days") <= limits.new_days, "New")
        .when(recency.isNull() | (recency > limits.idle_days), "Inactive")
        .otherwise("At-Risk")
    )
    return facts.withColumn("segment", cohort).drop("age_days")
