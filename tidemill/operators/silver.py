"""Bronze to silver: validation flags, typing, enrichment and URL parsing.

No join here is hinted. Spark broadcasts a dimension only when its size on disk or, at run time, its shuffled size is
under the threshold; a larger one is sort-merged, and adaptive execution splits the hot keys of the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import (
    clamp_non_negative,
    clean_text,
    full_name,
    norm_category,
    total_price,
    url_item_id,
    url_page,
    utm,
    valid_email,
)


def silver_users(users: DataFrame) -> DataFrame:
    """Users with an e-mail check and a full name. Bad addresses are marked, not dropped."""
    return users.withColumns(
        {"valid_email": valid_email(F.col("email")), "full_name": full_name(F.col("first_name"), F.col("last_name"))}
    )


def silver_items(items: DataFrame) -> DataFrame:
    """Items with negative prices set to 0 and upper-case categories."""
    return items.withColumns(
        {
            "price": clamp_non_negative(F.col("price"), "decimal(7,2)"),
            "category": norm_category(F.col("category")),
        }
    )


def _item_columns(items: DataFrame, key: str) -> DataFrame:
    return items.select(F.col("id").alias(key), F.col("name").alias("item_name"), F.col("category").alias("item_category"))


def enrich_purchases(purchases: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases with buyer and item attributes; a purchase of an unknown user or item is kept, with NULLs."""
    buyers = users.select(F.col("id").alias("user_id"), F.col("email").alias("user_email"))
    return (
        purchases.join(buyers, "user_id", "left")
        .join(_item_columns(items, "item_id"), "item_id", "left")
        .select(
            "id",
            "user_id",
            "item_id",
            "quantity",
            "purchase_price",
            total_price(F.col("quantity"), F.col("purchase_price")).alias("total_price"),
            "user_email",
            "item_name",
            "item_category",
            F.to_date("created_at").alias("purchase_date"),
            F.hour("created_at").alias("purchase_hour"),
            "created_at",
            "updated_at",
        )
    )


def pageviews_by_items(pageviews: DataFrame, items: DataFrame) -> DataFrame:
    """Views of pages whose URL ends in an item id, with the item's attributes where it is known."""
    parsed = pageviews.select(
        "user_id",
        url_item_id(F.col("url")).alias("item_id"),
        url_page(F.col("url")).alias("page"),
        "channel",
        "received_at",
    ).where(F.col("item_id").isNotNull())
    return parsed.join(_item_columns(items, "item_id"), "item_id", "left").select(
        "user_id", "item_id", "page", "item_name", "item_category", "channel", "received_at"
    )


def with_utm(df: DataFrame, url: str = "url", keys: tuple[str, ...] = ("source", "medium", "campaign")) -> DataFrame:
    """Campaign parameters of a URL as columns ``utm_source``, ``utm_medium``, ``utm_campaign``."""
    return df.withColumns({f"utm_{k}": utm(F.col(url), k) for k in keys})


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews without outer white space."""
    return reviews.withColumn("review", clean_text(F.col("review")))


def drop_orphans(facts: DataFrame, dims: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Facts all of whose references exist. ``dims`` maps a foreign key column to the table it points into."""
    for column, dim in dims.items():
        facts = facts.join(dim.select(F.col(key).alias(column)), column, "left_semi")
    return facts


def orphans(facts: DataFrame, dims: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """The facts that ``drop_orphans`` removes, with the first reference that is broken. One pass over the facts."""
    broken = None
    for column, dim in dims.items():
        found = f"__found_{column}"
        known = dim.select(F.col(key).alias(column)).distinct().withColumn(found, F.lit(True))
        facts = facts.join(known, column, "left")
        missing = F.col(found).isNull()
        broken = F.when(missing, F.lit(column)) if broken is None else broken.when(missing, F.lit(column))
    flags = [f"__found_{column}" for column in dims]
    return facts.withColumn("broken_key", broken).where(F.col("broken_key").isNotNull()).drop(*flags)
