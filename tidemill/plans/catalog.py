"""The register of queries: what runs on Spark, and the same question as SQL for a checking engine."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import fixed
from tidemill.operators import silver
from tidemill.plans.frames import FRAMES, frame, frame_sql, source
from tidemill.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Shop:
    """The tables and silver layer a query asks for, over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return source(self.spark, self.sf_dir, name)

    def frame(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)

    def users(self) -> DataFrame:
        return silver.silver_users(self.frame("users"))

    def items(self) -> DataFrame:
        return silver.silver_items(self.frame("items"))

    def purchases(self) -> DataFrame:
        return silver.enrich_purchases(self.frame("purchases"), self.frame("users"), self.frame("items"))

    def sales(self) -> DataFrame:
        return silver.enrich_purchases(self.frame("sales"), self.frame("users"), self.frame("items"))

    def views(self) -> DataFrame:
        return silver.pageviews_by_items(self.frame("pageviews"), self.frame("items"))


# The silver tables as the checking engine writes them.
_ENRICHED = """
    select p.id, p.user_id, p.item_id, p.quantity, p.purchase_price,
           cast(p.quantity * p.purchase_price as decimal(14,2)) as total_price,
           u.email as user_email, i.name as item_name, i.category as item_category,
           cast(p.created_at as date) as purchase_date, cast(hour(p.created_at) as int) as purchase_hour,
           p.created_at, p.updated_at
    from {p} p left join users u on p.user_id = u.id left join items i on p.item_id = i.id"""
SILVER_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "silver_users": (
        ("users",),
        f"select *, regexp_matches(email, '{fixed.EMAIL_PATTERN}') as valid_email, concat_ws(' ', first_name, last_name) as full_name "
        "from users",
    ),
    "silver_items": (
        ("items",),
        "select * replace (cast(case when price < 0 then 0 else price end as decimal(7,2)) as price, "
        "upper(category) as category) from items",
    ),
    "silver_purchases": (("purchases", "users", "items"), _ENRICHED.format(p="purchases")),
    "silver_sales": (("sales", "users", "items"), _ENRICHED.format(p="sales")),
    "silver_views": (
        ("pageviews", "items"),
        r"""select v.user_id, v.item_id, v.page, i.name as item_name, i.category as item_category, v.channel, v.received_at
            from (select user_id, try_cast(regexp_extract(url, '/(\d+)$', 1) as bigint) as item_id,
                         regexp_extract(url, '^/([^/]+)/\d+$', 1) as page, channel, received_at from pageviews) v
            left join items i on v.item_id = i.id where v.item_id is not null""",
    ),
}


def _ctes(names: tuple[str, ...]) -> dict[str, str]:
    found: dict[str, str] = {}
    for name in names:
        if name in SILVER_SQL:
            needs, text = SILVER_SQL[name]
            found |= _ctes(needs)
            found[name] = text
        elif name in FRAMES:
            found[name] = frame_sql(name)
        else:
            raise KeyError(name)
    return found


def check_sql(body: str, *needs: str) -> str:
    """One statement: the frames and silver tables ``body`` needs as CTEs, then the body."""
    ctes = ",\n".join(f"{name} as ({text})" for name, text in _ctes(needs).items())
    if not ctes:
        return body.strip()
    body = body.strip()
    return f"with {ctes}, {body[5:]}" if body.lower().startswith("with ") else f"with {ctes}\n{body}"


def plain(df: DataFrame) -> DataFrame:
    """Result types two engines print alike: decimals as double, dates as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(check: str | None = None, needs: tuple[str, ...] = ()):
    """Register a function of a ``Shop`` under its own name, with the SQL that must give the same rows."""

    def register(build: Callable[[Shop], DataFrame]):
        name = build.__name__

        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Shop(tune(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check_sql(check, *needs)
        return build

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from tidemill.plans import batch_queries, change_queries, learn_queries, metric_queries, stream_queries  # noqa: F401
