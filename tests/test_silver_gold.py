from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from tidemill.operators import conversion, dedup, engagement, features, sales, silver

NOW = ts("2024-01-31 10:30:00")


@pytest.fixture(scope="module")
def shop(spark):
    t = ts("2024-01-30 09:00:00")
    users = spark.createDataFrame(
        [(1, "A", "X", "a@x.org", t, t), (2, None, "Y", "bad@", t, t)],
        "id bigint, first_name string, last_name string, email string, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(10, "pen", "office", Decimal("-1.00"), 1, t, t), (11, "cup", "home", Decimal("5.00"), 1, t, t)],
        "id bigint, name string, category string, price decimal(7,2), inventory int, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    purchases = spark.createDataFrame(
        [
            (1, 1, 10, 2, Decimal("3.50"), ts("2024-01-30 10:30:00")),
            (2, 1, 99, 1, Decimal("1.00"), ts("2024-01-30 10:29:59")),
            (3, 7, 11, 1, Decimal("9.99"), ts("2024-01-31 10:05:00")),
            (4, None, None, 1, Decimal("2.00"), ts("2024-01-31 10:05:00")),
        ],
        "id bigint, user_id bigint, item_id bigint, quantity int, purchase_price decimal(12,2), created_at timestamp_ntz",
    ).withColumn("updated_at", F.col("created_at"))
    return users, items, purchases


def test_users_are_marked_not_dropped(shop):
    got = silver.silver_users(shop[0]).select("id", "valid_email", "full_name").collect()
    assert [tuple(r) for r in got] == [(1, True, "A X"), (2, False, "Y")]


def test_items_clamp_and_upper(shop):
    df = silver.silver_items(shop[1])
    assert df.schema["price"].dataType.simpleString() == "decimal(7,2)"
    assert rows(df.select("id", "price", "category")) == [(10, Decimal("0.00"), "OFFICE"), (11, Decimal("5.00"), "HOME")]


def test_enrichment_keeps_orphans(shop):
    users, items, purchases = shop
    df = silver.enrich_purchases(purchases, users, items)
    got = {r.id: r for r in df.collect()}
    assert got[1].total_price == Decimal("7.00") and got[1].item_category == "office" and got[1].purchase_hour == 10
    assert got[2].user_email == "a@x.org" and got[2].item_name is None
    assert got[3].user_email is None and got[3].item_name == "cup"
    assert got[4].user_email is None and got[4].item_name is None
    assert df.schema["total_price"].dataType.simpleString() == "decimal(14,2)"


def test_orphans_and_their_rejects(shop):
    users, items, purchases = shop
    dims = {"user_id": users, "item_id": items}
    assert [r.id for r in silver.drop_orphans(purchases, dims).collect()] == [1]
    assert rows(silver.orphans(purchases, dims).select("id", "broken_key")) == [(2, "item_id"), (3, "user_id"), (4, "user_id")]


def test_sales_24h_merges_the_boundary_hour(shop):
    users, items, purchases = shop
    got = rows(sales.sales_24h(silver.enrich_purchases(purchases, users, items), NOW))
    assert got == [(10, Decimal("18.99"))]


def test_top_selling_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame(
        [(3, "c", "x", Decimal("5.00")), (1, "a", "x", Decimal("5.00")), (2, "b", "x", Decimal("4.00"))],
        "item_id bigint, item_name string, item_category string, total_price decimal(14,2)",
    )
    top = sales.top_selling_items(df, 2)
    assert [r.item_id for r in top.collect()] == [1, 3]
    assert "TakeOrderedAndProject" in plan(top)


def _views(spark, data):
    return spark.createDataFrame(
        [(u, i, "items", "n", "c", "web", None if t is None else ts(t)) for u, i, t in data],
        "user_id bigint, item_id bigint, page string, item_name string, item_category string, channel string, received_at timestamp_ntz",
    )


def _bought(spark, data):
    return spark.createDataFrame(
        [(n, u, i, date.fromisoformat(d)) for n, u, i, d in data], "id bigint, user_id bigint, item_id bigint, purchase_date date"
    )


def test_conversion_counts_pairs(spark):
    views = _views(spark, [(1, 5, "2024-01-01 08:00:00")] * 3 + [(2, 5, "2024-01-01 09:00:00"), (None, 5, "2024-01-01 09:00:00"), (1, 5, None)])
    bought = _bought(spark, [(100, 1, 5, "2024-01-01"), (101, 1, 5, "2024-01-01"), (102, 1, 5, "2024-01-02"), (None, 2, 5, "2024-01-01")])
    row = conversion.conversion(views, bought).first()
    # 3 views x 2 purchases; user 2's match has no purchase id; the view without a time matches nothing.
    assert (row.unique_pageview_users, row.unique_purchase_users) == (2, 2)
    assert (row.total_purchases, row.total_pageviews) == (6, 3 * 2 + 1 + 1)
    assert row.conversion_rate == pytest.approx(6 / 8)
    plain = conversion.conversion(views, bought, distinct_views=True).first()
    assert (plain.total_purchases, plain.total_pageviews) == (2, 5)


def test_conversion_of_unknown_users_is_zero(spark):
    row = conversion.conversion(_views(spark, [(None, 5, "2024-01-01 08:00:00")]), _bought(spark, [(1, 1, 5, "2024-01-01")])).first()
    assert (row.total_pageviews, row.conversion_rate) == (0, 0.0)


def test_conversion_equals_the_joined_form(spark):
    views = spark.range(3000).select(
        (F.col("id") % 7).alias("user_id"), (F.pmod(F.hash("id"), F.lit(11))).cast("bigint").alias("item_id"), F.lit("p").alias("page"),
        F.lit("n").alias("item_name"), F.lit("c").alias("item_category"), F.lit("web").alias("channel"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 5 as int))").alias("received_at"),
    )
    bought = spark.range(400).select(
        "id", (F.pmod(F.hash("id"), F.lit(7))).cast("bigint").alias("user_id"), (F.col("id") % 11).alias("item_id"),
        F.expr("date_add(date'2024-01-01', cast(id % 5 as int))").alias("purchase_date"),
    )
    joined = views.alias("v").join(
        bought.alias("b"),
        (F.col("v.item_id") == F.col("b.item_id")) & (F.col("v.user_id") == F.col("b.user_id"))
        & (F.to_date("received_at") == F.col("purchase_date")),
        "left",
    )
    want = joined.groupBy("v.item_id").agg(
        F.countDistinct("v.user_id"), F.countDistinct("b.user_id"), F.count("b.id"), F.count("v.user_id")
    )
    got = conversion.conversion(views, bought).select(
        "item_id", "unique_pageview_users", "unique_purchase_users", "total_purchases", "total_pageviews"
    )
    assert rows(got) == rows(want)


def test_engagement_boundaries(spark):
    users = spark.createDataFrame(
        [(i, f"u{i}@x.org", f"U{i}", i != 9) for i in range(1, 10)] + [(4, "u4@x.org", "U4", True)],
        "id bigint, email string, full_name string, valid_email boolean",
    )
    views = _views(
        spark,
        [(1, 5, "2024-01-28 08:00:00")] * 50 + [(2, 5, "2024-01-24 08:00:00")] * 49 + [(3, 5, "2024-01-23 08:00:00")] * 10
        + [(4, 5, "2024-01-31 08:00:00")] * 5 + [(5, 5, "2024-01-27 00:00:00")] * 60,
    )
    got = {r.user_id: r for r in engagement.engagement(users, views, NOW).collect()}
    assert 9 not in got and len(got) == 8
    assert {u: got[u].engagement_segment.split("_")[0] for u in got} == {
        1: "high", 2: "medium", 3: "low", 4: "medium", 5: "low", 6: "low", 7: "low", 8: "low",
    }
    assert got[4].total_pageviews == 10 and got[4].active_days == 1
    assert (got[6].total_pageviews, got[6].last_active_date, got[6].days_since_last_active) == (0, None, None)


def test_rfv(spark):
    users = spark.createDataFrame([(i, ts(t)) for i, t in [(1, "2023-01-01"), (2, "2024-01-29"), (3, "2023-01-01"), (4, "2023-01-01")]], "id bigint, created_at timestamp_ntz")
    views = _views(spark, [(4, 1, "2024-01-21 00:00:00")])
    bought = spark.createDataFrame(
        [(1, Decimal("50.00"), date(2024, 1, 30))] * 3, "user_id bigint, total_price decimal(14,2), purchase_date date"
    )
    got = {r.user_id: r.segment for r in engagement.rfv_cohorts(users, views, bought, NOW).collect()}
    assert got == {1: "Champion", 2: "New", 3: "Inactive", 4: "At-Risk"}


def test_dedup_latest_has_one_winner(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, None, None), (2, "z", None)], "id bigint, v string, updated_at int"
    )
    latest = dedup.dedup_latest(df, ["id"], ["updated_at"])
    assert rows(latest) == [(1, "c", 2), (2, "z", None)]
    assert "WindowGroupLimit" in plan(latest)


def test_dedup_text_and_users(spark):
    df = spark.createDataFrame([(3, " hi "), (1, "hi"), (2, "ho"), (4, None), (5, None)], "id bigint, t string")
    assert rows(dedup.dedup_text(df, "t", "id")) == [(1, "hi"), (2, "ho"), (4, None)]
    users = spark.createDataFrame([(1, "A@x.org", 1), (2, " a@X.org", 2)], "id bigint, email string, updated_at int")
    assert rows(dedup.dedup_users(users)) == [(2, "a@x.org", 2)]


def test_features(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", 2, Decimal("2.00"), Decimal("4.00")), (1, 1, "a", 1, Decimal("4.00"), Decimal("4.00")), (1, 2, None, 1, Decimal("1.00"), Decimal("1.00")), (2, 3, "a", 1, Decimal("1.00"), Decimal("1.00"))],
        "user_id bigint, item_id bigint, item_category string, quantity int, purchase_price decimal(12,2), total_price decimal(14,2)",
    )
    row = features.user_item_features(df).where("user_id = 1 and item_id = 1").first()
    assert (row.purchase_count, row.total_quantity, row.total_spent, row.avg_price) == (2, 3, Decimal("8.00"), Decimal("3.000000"))
    assert rows(features.item_features(df).select("item_id", "category_popularity", "category_share")) == [
        (1, 3, pytest.approx(2 / 3)), (2, 1, 1.0), (3, 3, pytest.approx(1 / 3))
    ]
    assert rows(features.category_affinity(df).where("user_id = 1").select("item_category", "affinity")) == [
        ("a", pytest.approx(2 / 3)), (None, pytest.approx(1 / 3))
    ]


def test_revenue_by_category_sums_items_first(shop):
    users, items, purchases = shop
    got = sales.revenue_by_category(purchases, items, NOW)
    assert rows(got) == [("home", 1, Decimal("9.99"))]


def test_hot_and_missing_keys_are_split(spark):
    """A user with half of all purchases and a missing user with a quarter are spread over several join tasks."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        users = spark.range(500).select("id", F.concat(F.lit("u"), "id").alias("email"))
        items = spark.range(500).select("id", F.lit("n").alias("name"), F.lit("c").alias("category"))
        user = F.when(F.col("id") % 4 < 2, 7).when(F.col("id") % 4 == 2, None).otherwise(F.col("id") % 500)
        purchases = spark.range(0, 40_000, 1, 20).select(
            "id", user.cast("bigint").alias("user_id"), (F.col("id") % 600).alias("item_id"), F.lit(1).alias("quantity"),
            F.lit(Decimal("2.00")).cast("decimal(12,2)").alias("purchase_price"),
            F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("updated_at"),
        )
        joined = silver.enrich_purchases(purchases, users, items)
        got = joined.groupBy("user_email").agg(F.count("*").alias("n"))
        assert {r.user_email: r.n for r in got.collect() if r.n > 5000} == {"u7": 20_000 + 80, None: 10_000}
        assert "skew=true" in _as_run(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _as_run(df):
    """The plan after adaptive re-planning."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()
