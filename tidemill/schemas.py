"""Declared table schemas of the three layers, and the typed projection that enforces them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """Declared columns plus how files are laid out: by a column as is, or by the day of a timestamp."""

    schema: T.StructType
    by: str | None = None
    by_day: bool = False
    sort: tuple[str, ...] = ()

    @property
    def partition_column(self) -> str | None:
        return f"{self.by}_day" if self.by and self.by_day else self.by


_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money(7)": T.DecimalType(7, 2),
    "money(12)": T.DecimalType(12, 2),
    "money(14)": T.DecimalType(14, 2),
}


def declared(columns: str) -> T.StructType:
    """A schema from ``name type, ..``; unlike Spark's own parser this needs no session, so schemas can be constants."""
    fields = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


_USERS = "id bigint, first_name string, last_name string, email string, created_at timestamp_ntz, updated_at timestamp_ntz"
_ITEMS = (
    "id bigint, name string, category string, price money(7), inventory int, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
_PURCHASES = "id bigint, user_id bigint, item_id bigint, quantity int, purchase_price money(12)"

LAYOUTS: dict[str, Layout] = {
    "bronze.users": Layout(declared(_USERS), by="created_at", by_day=True),
    "bronze.items": Layout(declared(_ITEMS), by="category"),
    "bronze.purchases": Layout(
        declared(f"{_PURCHASES}, created_at timestamp_ntz, updated_at timestamp_ntz"), by="created_at", by_day=True
    ),
    "bronze.pageviews": Layout(
        declared("user_id bigint, url string, channel string, received_at timestamp_ntz"), by="received_at", by_day=True
    ),
    "silver.users": Layout(declared(f"{_USERS}, valid_email boolean, full_name string"), by="created_at", by_day=True),
    "silver.items": Layout(declared(_ITEMS), by="category"),
    "silver.purchases_enriched": Layout(
        declared(
            f"{_PURCHASES}, total_price money(14), user_email string, item_name string, item_category string, "
            "purchase_date date, purchase_hour int, created_at timestamp_ntz, updated_at timestamp_ntz"
        ),
        by="created_at",
        by_day=True,
    ),
    "silver.pageviews_by_items": Layout(
        declared(
            "user_id bigint, item_id bigint, page string, item_name string, item_category string, channel string, "
            "received_at timestamp_ntz"
        ),
        by="received_at",
        by_day=True,
    ),
    "silver.reviews": Layout(declared("review_id bigint, review string, date date")),
    "olap.purchases": Layout(
        declared(
            "id bigint, user_id bigint, item_id bigint, campaign_id string, status smallint, quantity int, "
            "purchase_price money(12), deleted boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
        ),
        sort=("item_id", "created_at"),
    ),
    "serving.user_recommendations": Layout(
        declared("user_id int, item_id int, score float, model_version string, generated_at timestamp_ntz")
    ),
}

LOGIN_EVENT = declared("user_id int, login_ts string, ip_address string, device string, is_success boolean")
PAGEVIEW_EVENT = LAYOUTS["bronze.pageviews"].schema
PURCHASE_EVENT = LAYOUTS["olap.purchases"].schema


def layout(name: str) -> Layout:
    """The declared layout of ``layer.table``; tables without one (gold, features) are stored as they come."""
    return LAYOUTS.get(name, Layout(T.StructType([])))


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Keep the declared columns only, in order, each cast to its declared type.

    A value that does not fit raises; with ``lenient`` it becomes NULL instead.
    """
    cast = (lambda f: F.col(f.name).try_cast(f.dataType)) if lenient else (lambda f: F.col(f.name).cast(f.dataType))
    return df.select(*[cast(f).alias(f.name) for f in schema.fields])


def with_defaults(df: DataFrame, schema: T.StructType, **defaults: object) -> DataFrame:
    """Add declared columns a producer left out, and fill NULLs of the named ones with their default."""
    present = set(df.columns)
    filled = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in present else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]))
        filled.append(value.cast(field.dataType).alias(field.name))
    return df.select(*filled)
