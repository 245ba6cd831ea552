from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import ts
from tidemill import functions as fn
from tidemill.functions.clock import from_micros, hour_start, last, micros
from tidemill.schemas import LAYOUTS, conform, with_defaults


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[1]}" for k, v in values.items()) or "x int"
    row = tuple(v[0] for v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("email", "ok"),
    [("a.b+c@x-y.org", True), ("a@host", False), ("no.at.sign", False), ("a@b.c", False), (None, None), ("x a@b.co", False)],
)
def test_valid_email(spark, email, ok):
    assert one(spark, fn.valid_email(F.col("e")), e=(email, "string")) is ok


def test_names_differ_on_missing_parts(spark):
    args = {"f": (None, "string"), "l": ("Doe", "string")}
    assert one(spark, fn.full_name(F.col("f"), F.col("l")), **args) == "Doe"
    assert one(spark, fn.full_name_strict(F.col("f"), F.col("l")), **args) is None


@pytest.mark.parametrize(
    ("url", "page", "item"),
    [
        ("/items/12", "items", 12),
        ("/a/b/7", "", 7),
        ("/home", "", None),
        ("/items/12/", "", None),
        ("/items/99999999999999999999", "items", None),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, page, item):
    assert one(spark, fn.url_page(F.col("u")), u=(url, "string")) == page
    assert one(spark, fn.url_item_id(F.col("u")), u=(url, "string")) == item


def test_utm(spark):
    url = "https://x.example/p?a=1&utm_source=mail&utm_medium=push#top"
    assert one(spark, fn.utm(F.col("u"), "source"), u=(url, "string")) == "mail"
    assert one(spark, fn.utm(F.col("u"), "campaign"), u=(url, "string")) is None
    assert one(spark, fn.utm(F.col("u"), "source"), u=("http://[bad", "string")) is None


@pytest.mark.parametrize(("value", "want"), [("-1.50", "0.00"), ("2.25", "2.25"), (None, None)])
def test_clamp_keeps_type(spark, value, want):
    got = one(spark, fn.clamp_non_negative(F.col("p").cast("decimal(7,2)"), "decimal(7,2)"), p=(value, "string"))
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize(
    ("views", "days", "want"),
    [
        (50, 3, "high"), (50, 4, "low"), (49, 7, "medium"), (10, 7, "medium"), (9, 0, "low"), (10, 8, "low"), (0, None, "low"),
        (60, None, "low"),
    ],
)
def test_engagement_segment(spark, views, days, want):
    got = one(spark, fn.engagement_segment(F.col("v"), F.col("d")), v=(views, "bigint"), d=(days, "int"))
    assert got == f"{want}_engagement"


def test_safe_ratio(spark):
    assert one(spark, fn.safe_ratio(F.col("a"), F.col("b")), a=(3, "bigint"), b=(0, "bigint")) == 0.0
    assert one(spark, fn.safe_ratio(F.col("a"), F.col("b")), a=(3, "bigint"), b=(4, "bigint")) == 0.75


def test_cosine(spark):
    args = {"a": ([1.0, 0.0], "array<float>"), "b": ([1.0, 1.0], "array<float>")}
    assert one(spark, fn.cosine_distance(F.col("a"), F.col("b")), **args) == pytest.approx(1 - 2**-0.5)
    args["b"] = ([0.0, 0.0], "array<float>")
    assert one(spark, fn.cosine_distance(F.col("a"), F.col("b")), **args) is None
    assert one(spark, fn.similarity_text(F.lit(0.25))) == "0.7500"


def test_clock_is_time_zone_free(spark):
    keep = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).select(fn.as_ntz(ts("2024-03-10 02:30:00.000123")).alias("t"))
            t = F.col("t")
            row = df.select(
                micros(t).alias("us"), from_micros(micros(t)).alias("back"), hour_start(t).alias("hour"), fn.day(t).alias("day"), F.hour(t).alias("h")
            ).first()
            assert row["us"] == 1710037800000123 and row["hour"] == ts("2024-03-10 02:00:00") and row["h"] == 2
            assert str(row["day"]) == "2024-03-10"
            assert row["back"] == ts("2024-03-10 02:30:00.000123")
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)


def test_trailing_bounds(spark):
    df = spark.createDataFrame([(ts(f"2024-01-30 00:00:0{i}"),) for i in (0, 1)], "t timestamp_ntz")
    now = ts("2024-01-31 00:00:00")
    assert last(df, "t", now, "24 hours").count() == 2
    assert last(df, "t", now, "24 hours", open_start=True).count() == 1


def test_event_time(spark):
    assert one(spark, fn.event_time(F.col("t")).cast("string"), t=("2024-01-01 10:00:00.250", "string")) == "2024-01-01 10:00:00.25"
    assert one(spark, fn.event_time(F.col("t")), t=("soon", "string")) is None


def test_tokens(spark):
    assert one(spark, fn.tokens(F.col("t")), t=("Éa, b--C3!", "string")) == ["éa", "b", "c3"]
    assert one(spark, fn.tokens(F.col("t")), t=(None, "string")) == []


def test_conform_and_defaults(spark):
    schema = LAYOUTS["olap.purchases"].schema
    raw = spark.createDataFrame([(7, 8, "3", "9.5", None)], "user_id int, item_id int, quantity string, purchase_price string, deleted boolean")
    full = with_defaults(raw, schema, id=0, campaign_id="", deleted=False, status=1)
    assert full.schema.simpleString() == schema.simpleString()
    row = full.first()
    assert (row.id, row.quantity, row.purchase_price, row.deleted, row.updated_at) == (0, 3, Decimal("9.50"), False, None)
    dirty = spark.createDataFrame([("x", "a")], "user_id string, url string").withColumns({"channel": F.lit("web"), "received_at": F.lit("?")})
    lenient = conform(dirty, LAYOUTS["bronze.pageviews"].schema, lenient=True).first()
    assert (lenient.user_id, lenient.url, lenient.received_at) == (None, "a", None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(dirty, LAYOUTS["bronze.pageviews"].schema).collect()
