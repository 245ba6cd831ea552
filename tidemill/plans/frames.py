"""The shop's tables, derived from the star-schema and event tables by row-local SQL that two engines understand.

The tokens in capitals stand for the few expressions that are written differently in Spark and in the checking engine.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

NOW = datetime(2024, 1, 31)
SENTINEL = datetime(2024, 3, 1)
CAMPAIGN = "FLASH2025"

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_SPARK = {
    "@K": r"""cast(regexp_extract(props, '"k": (\\d+)', 1) as bigint)""",
    "@T0": "timestamp_ntz'2024-01-01 00:00:00'",
    "@FMT": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')",
    "@HOUR": "cast(date_trunc('hour', ts) as timestamp_ntz)",
}
_CHECK = {
    "@K": r"""cast(regexp_extract(props, '"k": (\d+)', 1) as bigint)""",
    "@T0": "timestamp '2024-01-01 00:00:00'",
    "@FMT": "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')",
    "@HOUR": "date_trunc('hour', ts)",
}


def _days(expression: str, spark: bool) -> str:
    return f"make_dt_interval(cast({expression} as int))" if spark else f"to_days(cast({expression} as int))"


FRAMES: dict[str, str] = {
    "users": """
        select c_custkey as id, case when c_custkey % 7 = 0 then null else 'Customer' end as first_name,
               substring(c_name, 10) as last_name,
               case when c_custkey % 10 = 0 then concat('user', cast(c_custkey as string))
                    when c_custkey % 10 = 1 then concat('user', cast(c_custkey as string), '@host')
                    else concat('user', cast(c_custkey as string), '@', lower(c_mktsegment), '.example.com') end as email,
               @T0 + @DAYS(c_custkey % 30) as created_at, @T0 + @DAYS(c_custkey % 30) as updated_at
        from {customer}""",
    "items": """
        select p_partkey as id, p_name as name, lower(p_type) as category,
               cast(case when p_partkey % 50 = 0 then -p_retailprice else p_retailprice end as decimal(7,2)) as price,
               p_size as inventory, @T0 as created_at, @T0 + @DAYS(p_partkey % 30) as updated_at
        from {part}""",
    "purchases": f"""
        select event_id as id, user_id, case when event_id % 41 = 0 then 1000000000 + @K else @K end as item_id,
               case when event_id % 3 = 0 then '{CAMPAIGN}' end as campaign_id, cast(1 as smallint) as status,
               cast(case when event_id % 97 = 0 then 0 else 1 + event_id % 5 end as int) as quantity,
               cast(value as decimal(12,2)) as purchase_price, event_id % 20 = 0 as deleted,
               ts as created_at, ts as updated_at
        from {{events}} where event_type = 'purchase'""",
    "sales": """
        select o_orderkey * 10 + l_linenumber as id, o_custkey as user_id, l_partkey as item_id,
               cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(12,2)) as purchase_price,
               l_shipdate as created_at, l_shipdate as updated_at
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "pageviews": """
        select user_id,
               case when event_id % 13 = 0 then '/home' when event_id % 17 = 0 then concat('/a/b/', cast(@K as string))
                    else concat('/', case event_id % 3 when 0 then 'items' when 1 then 'products' else 'catalog' end, '/',
                                cast(@K as string)) end as url,
               case event_id % 4 when 0 then 'web' when 1 then 'mobile' when 2 then 'tablet' else 'api' end as channel,
               ts as received_at
        from {events} where event_type <> 'purchase'""",
    "logins": """
        select event_id, cast(user_id as int) as user_id, @FMT as login_ts,
               concat('192.168.1.', cast(event_id % 254 + 1 as string)) as ip_address,
               event_type as device, event_type <> 'error' as is_success
        from {events}""",
    "changes": """
        select event_id as seq, ts, @K as id, case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
               case when event_type <> 'error' then cast(event_id % 500 as int) end as inventory,
               case when event_type <> 'error' then cast(cast(value as decimal(7,2)) as string) end as price
        from {events}""",
    "images": """
        select event_id as seq, @K as id,
               case when event_id % 2 = 0 then cast(event_id % 500 as int) end as inventory_before,
               case when event_id % 6 <> 0 then cast(event_id % 500 as int) end as inventory_after,
               cast(value as decimal(7,2)) as price_before,
               cast(case when event_type = 'purchase' then value + 1 else value end as decimal(7,2)) as price_after
        from {events}""",
    "metrics": """
        select event_type as series, cast(user_id % 2 as int) as instance, ts, value as gauge,
               cast(event_id % 1000 as double) as counter
        from {events}""",
    "gaps": """
        select event_type as series, cast(user_id % 2 as int) as instance, @HOUR as ts,
               case when event_id % 7 = 0 then null when event_id % 11 = 0 then cast('NaN' as double)
                    when event_id % 13 = 0 then cast('Infinity' as double) else value end as gauge,
               case when event_id % 5 = 0 then null when event_id % 9 = 0 then cast('NaN' as double)
                    else cast(event_id % 1000 as double) end as counter
        from {events}""",
    "lag": """
        select event_type as series, cast(user_id % 2 as int) as instance, @HOUR as ts,
               cast(sum(cast(value as decimal(12,2))) as double) as value
        from {events} group by event_type, cast(user_id % 2 as int), @HOUR""",
    "reviews": """
        select doc_id as review_id, concat(case when doc_id % 3 = 0 then '  ' else '' end, text) as review,
               cast(@T0 + @DAYS(doc_id % 90) as date) as date
        from {documents}""",
}


def _render(name: str, tokens: dict[str, str], spark: bool) -> str:
    text = FRAMES[name]
    while "@DAYS(" in text:
        before, _, rest = text.partition("@DAYS(")
        inner, _, after = rest.partition(")")
        text = before + _days(inner, spark) + after
    for token, sql in tokens.items():
        text = text.replace(token, sql)
    return text


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """A frame over given tables, which may be streams."""
    used = {t: df for t, df in tables.items() if "{" + t + "}" in FRAMES[name]}
    return spark.sql(_render(name, _SPARK, spark=True), **used)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in SOURCES if "{" + t + "}" in FRAMES[name]]
    return derive(spark, name, {t: source(spark, sf_dir, t) for t in used})


def frame_sql(name: str) -> str:
    """The frame as SQL of the checking engine, over views named like the tables."""
    text = _render(name, _CHECK, spark=False)
    for table in SOURCES:
        text = text.replace("{" + table + "}", table)
    return text
