"""Silver, gold, engagement, quality and table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.operators import conversion, dedup, engagement, features, quality, sales, silver
from tidemill.operators.maintenance import compact_if_ready
from tidemill.plans import medallion
from tidemill.plans.catalog import Shop, query
from tidemill.plans.frames import CAMPAIGN, NOW
from tidemill.schemas import LAYOUTS, PAGEVIEW_EVENT
from tidemill.session import run_dir
from tidemill.sinks import append, export_csv, overwrite_partitions, replace_table
from tidemill.sources import quarantine_json, read_json_events, read_layer, register_views
from tidemill.sources.events import ISO_MICROS

_NOW = "timestamp '2024-01-31 00:00:00'"
_TOTAL = "cast(sum(total_price) as double)"


# Silver ---------------------------------------------------------------------------------------------------------------


@query("select * from silver_users", ("silver_users",))
def silver_users(shop: Shop) -> DataFrame:
    return shop.users()


@query("select * replace (cast(price as double) as price) from silver_items", ("silver_items",))
def silver_items(shop: Shop) -> DataFrame:
    return shop.items()


_PURCHASE_COLUMNS = """id, user_id, item_id, quantity, cast(purchase_price as double) as purchase_price,
    cast(total_price as double) as total_price, user_email, item_name, item_category,
    cast(purchase_date as varchar) as purchase_date, purchase_hour, created_at, updated_at"""


@query(f"select {_PURCHASE_COLUMNS} from silver_purchases", ("silver_purchases",))
def silver_purchases(shop: Shop) -> DataFrame:
    return shop.purchases()


@query("select * from silver_views", ("silver_views",))
def silver_pageviews(shop: Shop) -> DataFrame:
    return shop.views()


@query(
    """select id, user_id, item_id, quantity, cast(purchase_price as double) as purchase_price, created_at, updated_at
       from (select *, row_number() over (partition by id order by updated_at desc, user_id desc, item_id desc,
             quantity desc, purchase_price desc, created_at desc) as rn from sales) where rn = 1""",
    ("sales",),
)
def dedup_purchases(shop: Shop) -> DataFrame:
    return dedup.dedup_latest(shop.frame("sales"), ["id"], ["updated_at"])


@query(
    """select id, first_name, last_name, email, created_at, updated_at
       from (select * replace (lower(trim(email)) as email), row_number() over (partition by lower(trim(email))
             order by updated_at desc, id desc) as rn from users) where rn = 1""",
    ("users",),
)
def dedup_users(shop: Shop) -> DataFrame:
    return dedup.dedup_users(shop.frame("users"))


@query(
    """select review_id, review, cast(date as varchar) as date
       from (select review_id, trim(review) as review, date,
             row_number() over (partition by trim(review) order by review_id) as rn from reviews) where rn = 1""",
    ("reviews",),
)
def dedup_reviews(shop: Shop) -> DataFrame:
    return dedup.dedup_text(shop.frame("reviews"), "review", "review_id")


@query("select review_id, trim(review) as review, cast(date as varchar) as date from reviews", ("reviews",))
def review_clean(shop: Shop) -> DataFrame:
    return silver.clean_reviews(shop.frame("reviews"))


_RAW_PURCHASE = """id, user_id, item_id, campaign_id, status, quantity, cast(purchase_price as double) as purchase_price,
    deleted, created_at, updated_at"""


@query(
    f"""select {_RAW_PURCHASE} from purchases p where exists (select 1 from users u where u.id = p.user_id)
        and exists (select 1 from items i where i.id = p.item_id)""",
    ("purchases", "users", "items"),
)
def drop_orphans(shop: Shop) -> DataFrame:
    return silver.drop_orphans(shop.frame("purchases"), {"user_id": shop.frame("users"), "item_id": shop.frame("items")})


@query(
    f"""select {_RAW_PURCHASE}, case when not u then 'user_id' else 'item_id' end as broken_key
        from (select *, exists (select 1 from users u where u.id = p.user_id) as u,
              exists (select 1 from items i where i.id = p.item_id) as i from purchases p) where not (u and i)""",
    ("purchases", "users", "items"),
)
def orphan_rejects(shop: Shop) -> DataFrame:
    return silver.orphans(shop.frame("purchases"), {"user_id": shop.frame("users"), "item_id": shop.frame("items")})


def _utm_sql(key: str) -> str:
    return f"nullif(regexp_extract(url, '[?&]utm_{key}=([^&#]*)', 1), '') as utm_{key}"


@query(f"select page_id, url, {_utm_sql('source')}, {_utm_sql('medium')}, {_utm_sql('campaign')} from pages")
def utm_params(shop: Shop) -> DataFrame:
    return silver.with_utm(shop.table("pages").select("page_id", "url"))


# Gold -----------------------------------------------------------------------------------------------------------------

_TOP = f"""select item_id, item_name, item_category, {_TOTAL} as total_revenue from {{t}}
    group by all order by sum(total_price) desc, item_id limit 10"""


@query(_TOP.format(t="silver_purchases"), ("silver_purchases",))
def top_selling_items(shop: Shop) -> DataFrame:
    return sales.top_selling_items(shop.purchases())


@query(_TOP.format(t="silver_sales"), ("silver_sales",))
def top_selling_items_large(shop: Shop) -> DataFrame:
    return sales.top_selling_items(shop.sales())


@query(
    f"""select item_id, item_name, item_category, cast(purchase_date as varchar) as purchase_date, {_TOTAL} as total_revenue
        from silver_purchases where created_at >= {_NOW} - interval 30 day group by all""",
    ("silver_purchases",),
)
def top_selling_daily(shop: Shop) -> DataFrame:
    return sales.top_selling_daily(shop.purchases(), NOW)


@query(
    f"select purchase_hour, {_TOTAL} as total_revenue from silver_purchases "
    f"where created_at >= {_NOW} - interval 24 hour group by all",
    ("silver_purchases",),
)
def sales_24h(shop: Shop) -> DataFrame:
    return sales.sales_24h(shop.purchases(), NOW)


# Pairs counted as the operator defines them: per item, user and day, every view meets every purchase; a view that meets none
# still counts once.
_FUNNEL = """
    with seen as (select item_id, item_name, item_category, user_id, cast(received_at as date) as day, count(*) as views
                  from silver_views group by all),
         bought as (select item_id, user_id, purchase_date as day, count(*) as purchases from silver_purchases group by all),
         met as (select seen.*, coalesce(purchases, 0) as purchases
                 from seen left join bought on seen.item_id = bought.item_id and seen.user_id = bought.user_id and seen.day = bought.day),
         rates as (select item_id, item_name, item_category, count(distinct user_id) as unique_pageview_users,
                          count(distinct user_id) filter (purchases > 0) as unique_purchase_users,
                          cast(sum(views * purchases) as bigint) as total_purchases,
                          cast(sum(views * greatest(purchases, 1)) as bigint) as total_pageviews
                   from met group by all)
    select *, round(total_purchases / total_pageviews, 6) as conversion_rate from rates"""


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    _FUNNEL + " order by total_purchases / total_pageviews desc, item_id limit 10",
    ("silver_views", "silver_purchases"),
)
def top_converting_items(shop: Shop) -> DataFrame:
    return _rounded(conversion.top_converting_items(shop.views(), shop.purchases()), "conversion_rate")


@query(_FUNNEL, ("silver_views", "silver_purchases"))
def item_conversion(shop: Shop) -> DataFrame:
    return _rounded(conversion.conversion(shop.views(), shop.purchases()), "conversion_rate")


@query(
    """with v as (select item_id, item_name, item_category, user_id, cast(received_at as date) as d, count(*) as n
                  from silver_views group by all),
            b as (select item_id, user_id, purchase_date as d, count(*) as n from silver_purchases group by all)
       select v.item_id, v.item_name, v.item_category, count(distinct v.user_id) as unique_pageview_users,
              count(distinct b.user_id) as unique_purchase_users, cast(coalesce(sum(b.n), 0) as bigint) as total_purchases,
              cast(sum(v.n) as bigint) as total_pageviews, round(coalesce(sum(b.n), 0) / sum(v.n), 6) as conversion_rate
       from v left join b on v.item_id = b.item_id and v.user_id = b.user_id and v.d = b.d
       group by all order by coalesce(sum(b.n), 0) / sum(v.n) desc, v.item_id limit 10""",
    ("silver_views", "silver_purchases"),
)
def top_converting_items_distinct(shop: Shop) -> DataFrame:
    top = conversion.top_converting_items(shop.views(), shop.purchases(), distinct_views=True)
    return _rounded(top, "conversion_rate")


@query("select channel, count(*) as total_pageviews from silver_views group by all", ("silver_views",))
def pageviews_by_channel(shop: Shop) -> DataFrame:
    return sales.pageviews_by_channel(shop.views())


@query(
    "select channel, cast(cast(received_at as date) as varchar) as view_date, count(*) as total_pageviews "
    "from silver_views group by all",
    ("silver_views",),
)
def channel_daily(shop: Shop) -> DataFrame:
    return sales.channel_daily(shop.views())


@query(
    f"""select date_trunc('hour', created_at) as hour, cast(sum(quantity) as bigint) as total_sales from purchases
        where not deleted and created_at >= {_NOW} - interval 24 hour group by all""",
    ("purchases",),
)
def hourly_volume(shop: Shop) -> DataFrame:
    return sales.hourly_volume(shop.frame("purchases"), NOW)


@query(
    f"""select date_trunc('hour', created_at) as hour, cast(sum(quantity) as bigint) as total_sales from purchases
        where not deleted and campaign_id = '{CAMPAIGN}' and created_at >= {_NOW} - interval 24 hour group by all""",
    ("purchases",),
)
def hourly_volume_campaign(shop: Shop) -> DataFrame:
    return sales.hourly_volume(shop.frame("purchases"), NOW, CAMPAIGN)


@query(
    """select item_id, cast(sum(quantity) as bigint) as total_quantity,
              cast(sum(quantity * purchase_price) as double) as total_revenue
       from purchases group by all order by sum(quantity * purchase_price) desc, item_id limit 10""",
    ("purchases",),
)
def flash_top_items(shop: Shop) -> DataFrame:
    return sales.flash_top_items(shop.frame("purchases"))


@query(
    f"""select category, count(*) as purchase_count, cast(sum(p.purchase_price) as double) as total_revenue
        from purchases p join silver_items i on p.item_id = i.id
        where p.created_at > {_NOW} - interval 24 hour group by all""",
    ("purchases", "silver_items"),
)
def revenue_by_category(shop: Shop) -> DataFrame:
    return sales.revenue_by_category(shop.frame("purchases"), shop.items(), NOW)


@query(
    f"""select count(*) as purchases, cast(sum(purchase_price) as double) as revenue from purchases
        where created_at > {_NOW} - interval 1 hour""",
    ("purchases",),
)
def purchase_volume(shop: Shop) -> DataFrame:
    return sales.purchase_volume(shop.frame("purchases"), NOW)


@query(
    f"""select item_id, count(*) as purchases, cast(sum(purchase_price) as double) as revenue from purchases
        where created_at > {_NOW} - interval 24 hour group by all""",
    ("purchases",),
)
def item_sales(shop: Shop) -> DataFrame:
    return sales.item_sales(shop.frame("purchases"), NOW)


@query(
    "select * replace (cast(price as double) as price) from items order by updated_at desc, id desc limit 20", ("items",)
)
def recent_items(shop: Shop) -> DataFrame:
    return sales.recent_rows(shop.frame("items"))


@query(
    f"""select t.*, i.name as live_name from ({_TOP.format(t="silver_purchases")}) t join items i on t.item_id = i.id""",
    ("silver_purchases", "items"),
)
def join_live(shop: Shop) -> DataFrame:
    return sales.join_live(sales.top_selling_items(shop.purchases()), shop.frame("items"))


# Engagement -----------------------------------------------------------------------------------------------------------

# Activity counted per day first; the limits are the operator's.
_ENGAGED = f"""
    with daily as (select user_id, cast(received_at as date) as day, count(*) as views from silver_views group by all),
         active as (select user_id, sum(views) as views, count(*) as days, max(day) as last_day from daily group by all),
         a as (select u.id as user_id, email, full_name, cast(coalesce(views, 0) as bigint) as total_pageviews,
                      coalesce(days, 0) as active_days, cast(last_day as varchar) as last_active_date,
                      cast(date '2024-01-31' - last_day as int) as days_since_last_active
               from silver_users u left join active on active.user_id = u.id where u.valid_email)
    select a.*,
           case when total_pageviews >= {fixed.HIGH_MIN_VIEWS} and days_since_last_active <= {fixed.HIGH_MAX_DAYS} then '{fixed.HIGH}'
                when total_pageviews between {fixed.MEDIUM_MIN_VIEWS} and {fixed.MEDIUM_MAX_VIEWS}
                     and days_since_last_active <= {fixed.MEDIUM_MAX_DAYS} then '{fixed.MEDIUM}'
                else '{fixed.LOW}' end as engagement_segment
    from a"""


@query(_ENGAGED, ("silver_users", "silver_views"))
def engagement_segments(shop: Shop) -> DataFrame:
    return engagement.engagement(shop.users(), shop.views(), NOW)


@query(
    f"select engagement_segment, count(*) as users from ({_ENGAGED}) e group by all",
    ("silver_users", "silver_views"),
)
def segment_sizes(shop: Shop) -> DataFrame:
    return engagement.segment_sizes(engagement.engagement(shop.users(), shop.views(), NOW))


@query(
    """with v as (select user_id, max(cast(received_at as date)) as d from silver_views group by all),
            b as (select user_id, count(*) as n, sum(total_price) as s, max(purchase_date) as d from silver_purchases group by all),
            f as (select u.id as user_id, cast(date_diff('day', greatest(v.d, b.d), date '2024-01-31') as int) as recency_days,
                         coalesce(b.n, 0) as frequency, cast(coalesce(b.s, 0) as double) as value,
                         date_diff('day', cast(u.created_at as date), date '2024-01-31') as age
                  from silver_users u left join v on u.id = v.user_id left join b on u.id = b.user_id)
       select user_id, recency_days, frequency, value,
              case when recency_days <= 7 and frequency >= 3 and value >= 100 then 'Champion' when age <= 7 then 'New'
                   when recency_days is null or recency_days > 14 then 'Inactive' else 'At-Risk' end as segment from f""",
    ("silver_users", "silver_views", "silver_purchases"),
)
def rfv_cohorts(shop: Shop) -> DataFrame:
    return engagement.rfv_cohorts(shop.users(), shop.views(), shop.purchases(), NOW)


# Spark's mean of a decimal has six digits, rounded half up; the same in whole numbers, from cents.
_AVG = "cast((cast(sum({c}) * 100 as hugeint) * 20000 + count(*)) // (2 * count(*)) as double) / 1000000"


# Features -------------------------------------------------------------------------------------------------------------


@query(
    f"""select user_id, item_id, count(*) as purchase_count, cast(sum(quantity) as bigint) as total_quantity,
              cast(sum(total_price) as double) as total_spent,
              {_AVG.format(c='purchase_price')} as avg_price from silver_sales group by all""",
    ("silver_sales",),
)
def user_item_features(shop: Shop) -> DataFrame:
    return features.user_item_features(shop.sales())


@query(
    f"""select user_id, count(*) as total_orders, cast(sum(total_price) as double) as lifetime_value,
              {_AVG.format(c='total_price')} as avg_order_value from silver_sales group by all""",
    ("silver_sales",),
)
def user_features(shop: Shop) -> DataFrame:
    return features.user_features(shop.sales())


@query(
    """with i as (select item_id, item_category, count(*) as purchase_count from silver_sales group by all),
            c as (select item_category, cast(sum(purchase_count) as bigint) as category_popularity from i group by all)
       select i.item_id, i.item_category, purchase_count, category_popularity,
              round(purchase_count / category_popularity, 6) as category_share
       from i join c on i.item_category is not distinct from c.item_category""",
    ("silver_sales",),
)
def item_features(shop: Shop) -> DataFrame:
    return _rounded(features.item_features(shop.sales()), "category_share")


@query(
    """with c as (select user_id, item_category, count(*) as purchases from silver_sales group by all)
       select user_id, item_category, purchases, round(purchases / sum(purchases) over (partition by user_id), 6) as affinity
       from c""",
    ("silver_sales",),
)
def category_affinity(shop: Shop) -> DataFrame:
    return _rounded(features.category_affinity(shop.sales()), "affinity")


# Quality --------------------------------------------------------------------------------------------------------------


def _bronze(shop: Shop) -> dict[str, DataFrame]:
    return {name: shop.frame(name) for name in ("users", "items", "purchases", "pageviews")}


@query(
    " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in ("users", "items", "purchases", "pageviews")
    ),
    ("users", "items", "purchases", "pageviews"),
)
def table_counts(shop: Shop) -> DataFrame:
    return quality.table_counts(_bronze(shop))


def _rule_sql(suite: str, table: str, rule: str, column: str, args: str, broken: str) -> str:
    return (
        f"select '{suite}' as suite, '{rule}' as rule, '{column}' as column_name, '{args}' as args, count(*) as total, "
        f"count(*) filter (where {broken}) as unexpected, "
        f"round(count(*) filter (where {broken}) * 100.0 / count(*), 6) as unexpected_pct, "
        f"count(*) filter (where {broken}) = 0 as success from {table}"
    )


_REPORT_SQL = " union all ".join(
    [
        _rule_sql("bronze_users", "users", "not_null", "id", "{}", "id is null"),
        _rule_sql("bronze_users", "users", "not_null", "email", "{}", "email is null"),
        _rule_sql("bronze_users", "users", "matches", "email", '{"regex": "@"}', "not regexp_matches(email, '@')"),
        _rule_sql("bronze_items", "items", "not_null", "id", "{}", "id is null"),
        _rule_sql("bronze_items", "items", "not_null", "category", "{}", "category is null"),
        _rule_sql("bronze_items", "items", "between", "price", '{"max": null, "min": 0}', "price < 0"),
        _rule_sql("bronze_purchases", "purchases", "not_null", "id", "{}", "id is null"),
        _rule_sql("bronze_purchases", "purchases", "between", "quantity", '{"max": null, "min": 1}', "quantity < 1"),
        _rule_sql(
            "bronze_purchases", "purchases", "between", "purchase_price", '{"max": null, "min": 0}', "purchase_price < 0"
        ),
        _rule_sql("bronze_pageviews", "pageviews", "not_null", "user_id", "{}", "user_id is null"),
        _rule_sql("bronze_pageviews", "pageviews", "not_null", "url", "{}", "url is null"),
    ]
)


@query(_REPORT_SQL, ("users", "items", "purchases", "pageviews"))
def quality_report(shop: Shop) -> DataFrame:
    return _rounded(quality.quality_report(_bronze(shop)), "unexpected_pct")


@query(
    """select 'row_count' as rule, count(*) as total, cast(count(*) < 1 as bigint) as unexpected, count(*) >= 1 as success
       from purchases
       union all select 'of_type', count(*), 0, true from purchases
       union all select 'not_null', count(*), count(*) filter (where user_id is null), count(user_id) = count(*) from purchases
       union all select 'not_null', count(*), count(*) filter (where item_id is null), count(item_id) = count(*) from purchases
       union all select 'not_null', count(*), count(*) filter (where purchase_price is null),
                        count(purchase_price) = count(*) from purchases
       union all select 'between', count(*), count(*) filter (where not purchase_price between 0 and 100000),
                        count(*) filter (where not purchase_price between 0 and 100000) = 0 from purchases""",
    ("purchases",),
)
def quality_extended(shop: Shop) -> DataFrame:
    results = quality.PURCHASES_EXTENDED.results(shop.frame("purchases"))
    return results.select("rule", "total", "unexpected", "success")


@query(
    f"""select {_RAW_PURCHASE}, concat_ws(',', case when id is null then 'not_null(id)' end,
               case when quantity < 1 then 'between(quantity)' end,
               case when purchase_price < 0 then 'between(purchase_price)' end) as broken_rules
        from purchases where id is null or quantity < 1 or purchase_price < 0""",
    ("purchases",),
)
def quality_quarantine(shop: Shop) -> DataFrame:
    _, bad = quality.BRONZE_SUITES["purchases"].split(shop.frame("purchases"))
    return bad.withColumn("broken_rules", F.array_join("broken_rules", ","))


@query(
    f"select {_RAW_PURCHASE} from purchases where id is not null and quantity >= 1 and purchase_price >= 0", ("purchases",)
)
def quality_clean(shop: Shop) -> DataFrame:
    good, _ = quality.BRONZE_SUITES["purchases"].split(shop.frame("purchases"))
    return good


# Tables written and read back -----------------------------------------------------------------------------------------

_BRONZE_PURCHASE = "id, user_id, item_id, {q} as quantity, cast(purchase_price as double) as purchase_price, created_at, updated_at"


@query(
    f"""select {_BRONZE_PURCHASE.format(q="case when created_at >= timestamp '2024-01-20' then quantity + 1 else quantity end")}
        from purchases""",
    ("purchases",),
)
def partition_overwrite(shop: Shop) -> DataFrame:
    """All days, then a corrected extract of the days from the 20th on: only those are replaced."""
    root = run_dir(shop.spark, "overwrite")
    purchases = shop.frame("purchases")
    overwrite_partitions(purchases, root, "bronze", "purchases")
    corrected = purchases.where("created_at >= timestamp_ntz'2024-01-20 00:00:00'").withColumn("quantity", F.col("quantity") + 1)
    overwrite_partitions(corrected, root, "bronze", "purchases")
    return read_layer(shop.spark, root, "bronze", "purchases")


@query("select * from pageviews union all select * from pageviews", ("pageviews",))
def compacted_table(shop: Shop) -> DataFrame:
    """Two appends of the page views, compacted into the table's next version."""
    root = run_dir(shop.spark, "compact")
    views = shop.frame("pageviews")
    append(views, root, "bronze", "pageviews")
    append(views, root, "bronze", "pageviews")
    compact_if_ready(shop.spark, root, "bronze", "pageviews")
    return read_layer(shop.spark, root, "bronze", "pageviews")


@query(_ENGAGED, ("silver_users", "silver_views"))
def csv_roundtrip(shop: Shop) -> DataFrame:
    segments = engagement.engagement(shop.users(), shop.views(), NOW)
    path = export_csv(segments, run_dir(shop.spark, "segments"), NOW.date())
    schema = (
        "user_id bigint, email string, full_name string, total_pageviews bigint, active_days bigint, "
        "last_active_date date, days_since_last_active int, engagement_segment string"
    )
    return shop.spark.read.option("header", True).option("escape", '"').schema(schema).csv(path).select(*fixed.CSV_SEGMENT_HEADER)


@query("select * from pageviews", ("pageviews",))
def json_ingest(shop: Shop) -> DataFrame:
    path = run_dir(shop.spark, "json")
    shop.frame("pageviews").write.option("timestampNTZFormat", ISO_MICROS).json(path)
    return read_json_events(shop.spark, path, PAGEVIEW_EVENT)


@query(
    """select 'good' as kind, count(*) as lines from pageviews where channel <> 'api'
       union all select 'bad', count(*) from pageviews where channel = 'api'""",
    ("pageviews",),
)
def json_quarantine(shop: Shop) -> DataFrame:
    """Page views as lines, those of one channel cut short in the middle of the object."""
    path = run_dir(shop.spark, "lines")
    line = F.to_json(F.struct("*"), {"timestampNTZFormat": ISO_MICROS})
    cut = F.when(F.col("channel") == "api", F.expr("left(line, length(line) - 5)")).otherwise(F.col("line"))
    shop.frame("pageviews").withColumn("line", line).select(cut.alias("value")).write.text(path)
    good, bad = quarantine_json(shop.spark, path, PAGEVIEW_EVENT)
    counted = good.agg(F.count(F.lit(1)).alias("lines")).select(F.lit("good").alias("kind"), "lines")
    return counted.unionByName(bad.agg(F.count(F.lit(1)).alias("lines")).select(F.lit("bad").alias("kind"), "lines"))


_CLEAN_TOP = """
    with u as (select * from users where regexp_matches(email, '@')),
         i as (select * from items where price >= 0),
         p as (select * from purchases where quantity >= 1 and purchase_price >= 0)
    select p.item_id, i.name as item_name, i.category as item_category,
           cast(sum(cast(p.quantity * p.purchase_price as decimal(14,2))) as double) as total_revenue
    from p left join u on p.user_id = u.id left join i on p.item_id = i.id
    group by all order by sum(cast(p.quantity * p.purchase_price as decimal(14,2))) desc, item_id limit 10"""


@query(_CLEAN_TOP, ("users", "items", "purchases"))
def medallion_gold(shop: Shop) -> DataFrame:
    """The whole batch flow on the rows that pass the gate, read back from the gold layer."""
    root = run_dir(shop.spark, "lake")
    clean = {name: quality.BRONZE_SUITES[name].split(df)[0] for name, df in _bronze(shop).items()}
    medallion.run_batch(shop.spark, clean, root, NOW)
    return read_layer(shop.spark, root, "gold", "top_selling_items")


# The second day: every third item has another category and name, one category vanishes, and the last day's quantities are corrected.
_DAY = "timestamp '2024-01-20 00:00:00'"
_SECOND_DAY = f"""
    i2 as (select * replace (case when id % 3 = 0 or category = (select min(category) from items) then 'moved' else category end as category,
                             case when id % 3 = 0 then name || ' II' else name end as name)
           from items where price >= 0),
    u2 as (select * replace (case when id % 5 = 0 then 'new' || email else email end as email) from users
           where regexp_matches(email, '@')),
    p2 as (select * replace (case when created_at >= {_DAY} then quantity + 1 else quantity end as quantity) from purchases
           where quantity >= 1 and purchase_price >= 0),
    s2 as (select p.id, p.user_id, p.item_id, p.quantity, cast(p.quantity * p.purchase_price as decimal(14,2)) as total_price,
                  u.email as user_email, i.name as item_name, i.category as item_category
           from p2 p left join u2 u on p.user_id = u.id left join i2 i on p.item_id = i.id)"""


def _second_day(shop: Shop) -> str:
    """Two runs of the batch flow; the second day's extracts hold what has changed, and the last days' purchases."""
    root = run_dir(shop.spark, "lake")
    first = {name: quality.BRONZE_SUITES[name].split(df)[0] for name, df in _bronze(shop).items()}
    medallion.run_batch(shop.spark, first, root, NOW)
    items, users, purchases = first["items"], first["users"], first["purchases"]
    gone = F.col("category") == shop.frame("items").agg(F.min("category")).first()[0]
    later = F.col("updated_at") + F.expr("interval 60 days")
    third = F.col("id") % 3 == 0
    second = {
        "items": items.where(third | gone).withColumns(
            {"category": F.lit("moved"), "name": F.when(third, F.concat("name", F.lit(" II"))).otherwise(F.col("name")), "updated_at": later}
        ),
        "users": users.where("id % 5 = 0").withColumns({"email": F.concat(F.lit("new"), "email"), "updated_at": later}),
        "purchases": purchases.where("created_at >= timestamp_ntz'2024-01-20 00:00:00'").withColumn("quantity", F.col("quantity") + 1),
        "pageviews": first["pageviews"].limit(0),
    }
    medallion.run_batch(shop.spark, second, root, NOW, keep=1)
    return root


@query(
    f"with {_SECOND_DAY.strip()} select * replace (cast(total_price as double) as total_price) from s2",
    ("users", "items", "purchases"),
)
def medallion_second_day(shop: Shop) -> DataFrame:
    """Silver purchases after a second day on which rows moved between partitions: nothing is doubled or out of date."""
    stored = read_layer(shop.spark, _second_day(shop), "silver", "purchases_enriched")
    return stored.select("id", "user_id", "item_id", "quantity", "total_price", "user_email", "item_name", "item_category")


@query(
    f"""with {_SECOND_DAY.strip()}
        select 'top item' as kind, cast(item_id as varchar) as name, cast(total as double) as revenue from (
            select item_id, sum(total_price) as total from s2 group by all order by total desc, item_id limit 10)
        union all select 'category', upper(category), cast(count(*) as double) from i2 group by all""",
    ("users", "items", "purchases"),
)
def medallion_second_day_gold(shop: Shop) -> DataFrame:
    """Gold revenue after the second day, and the number of items that silver has in each category."""
    root = _second_day(shop)
    top = read_layer(shop.spark, root, "gold", "top_selling_items")
    items = read_layer(shop.spark, root, "silver", "items").groupBy(F.col("category").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("revenue"))
    return top.select(F.lit("top item").alias("kind"), F.col("item_id").cast("string").alias("name"), F.col("total_revenue").cast("double").alias("revenue")).unionByName(
        items.withColumn("kind", F.lit("category"))
    )


@query(
    f"select cast(hour(created_at) as int) as purchase_hour, {_TOTAL} as total_revenue from silver_purchases "
    f"where created_at >= {_NOW} - interval 24 hour group by all",
    ("silver_purchases",),
)
def layer_scan_24h(shop: Shop) -> DataFrame:
    """The 24-hour report from the stored silver table, whose older day folders are pruned."""
    root = run_dir(shop.spark, "silver")
    replace_table(shop.purchases(), root, "silver", "purchases_enriched")
    stored = read_layer(shop.spark, root, "silver", "purchases_enriched", with_partition=True)
    assert stored.columns[:-1] == LAYOUTS["silver.purchases_enriched"].schema.names
    return sales.sales_24h(stored, NOW)


@query(
    """select item_category, purchase_date, count(*) as purchases, cast(sum(total_price) as double) as revenue from (
           select item_category, cast(purchase_date as varchar) as purchase_date, total_price from silver_purchases)
       group by all""",
    ("silver_purchases",),
)
def layer_sql(shop: Shop) -> DataFrame:
    """An analyst's SQL over stored layer tables."""
    root = run_dir(shop.spark, "sql")
    replace_table(shop.purchases(), root, "silver", "purchases_enriched")
    register_views(shop.spark, root, ["silver.purchases_enriched"])
    return shop.spark.sql(
        "select item_category, purchase_date, count(*) as purchases, sum(total_price) as revenue "
        "from silver_purchases_enriched group by all"
    )

