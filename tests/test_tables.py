from __future__ import annotations

import glob
import json
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from tidemill import fixed
from tidemill.functions.clock import last
from tidemill.operators.maintenance import compact_if_ready, drop_old_versions
from tidemill.schemas import LAYOUTS, PAGEVIEW_EVENT
from tidemill.sinks import append, compact, export_csv, init_layers, jdbc_write_options, merge_rows, overwrite_partitions, replace_table
from tidemill.sources import is_ready, jdbc_read_options, lookup, pending, quarantine_json, read_dimension, read_json_events, read_layer, register_views
from tidemill.sources.jdbc import KeyRange
from tidemill.sources.versions import numbered

SCHEMA = "user_id bigint, url string, channel string, received_at timestamp_ntz"


def views(spark, *data):
    return spark.createDataFrame([(u, "/items/1", "web", ts(t)) for u, t in data], SCHEMA)


def test_overwrite_replaces_only_partitions_in_the_input(spark, folder):
    first = views(spark, (1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00"), (3, "2024-01-02 01:00:00"))
    assert overwrite_partitions(first, folder, "bronze", "pageviews").rows == 3
    report = overwrite_partitions(views(spark, (9, "2024-01-01 03:00:00")), folder, "bronze", "pageviews")
    assert report.rows == 1
    stored = read_layer(spark, folder, "bronze", "pageviews")
    assert stored.schema.names == LAYOUTS["bronze.pageviews"].schema.names
    assert rows(stored.select("user_id")) == [(3,), (9,)]
    assert overwrite_partitions(first.limit(0), folder, "bronze", "pageviews").rows == 0
    assert stored.count() == 2


def test_first_write_may_be_empty(spark, folder):
    overwrite_partitions(views(spark).limit(0), folder, "bronze", "pageviews")
    assert read_layer(spark, folder, "bronze", "pageviews").count() == 0


def test_replace_may_read_what_it_replaces(spark, folder):
    replace_table(spark.range(3), folder, "gold", "t")
    replace_table(read_layer(spark, folder, "gold", "t").where("id > 0"), folder, "gold", "t")
    assert rows(read_layer(spark, folder, "gold", "t")) == [(1,), (2,)]
    assert numbered(spark, f"{folder}/gold/t") == [0, 1]


def test_unfinished_version_is_not_read(spark, folder):
    replace_table(spark.range(3), folder, "gold", "t")
    spark.range(99).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/gold/t/v000001")
    assert read_layer(spark, folder, "gold", "t").count() == 3


def test_compaction(spark, folder):
    for i in range(6):
        append(views(spark, *[(i, f"2024-01-01 0{h}:00:00") for h in range(5)]).repartition(5), folder, "bronze", "pageviews")
    before = read_layer(spark, folder, "bronze", "pageviews")
    n_before, content = len(glob.glob(f"{folder}/bronze/pageviews/v000000/*/*.parquet")), rows(before)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    report = compact(spark, folder, "bronze", "pageviews")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size
    assert report.rows == 30 and rows(read_layer(spark, folder, "bronze", "pageviews")) == content
    assert len(glob.glob(f"{folder}/bronze/pageviews/v000001/*/*.parquet")) < n_before
    assert compact_if_ready(spark, folder, "bronze", "users") is None


def test_day_folders_and_columns_are_pruned(spark, folder):
    data = [(i, f"2024-01-{d:02d} 12:00:00") for i, d in enumerate(range(1, 31))]
    overwrite_partitions(views(spark, *data), folder, "bronze", "pageviews")
    stored = read_layer(spark, folder, "bronze", "pageviews", with_partition=True)
    recent = last(stored, "received_at", ts("2024-01-31 00:00:00"), "24 hours").select("user_id")
    text = plan(recent)
    assert rows(recent) == [(29,)]
    assert "PartitionFilters: [isnotnull(received_at_day" in text
    assert "ReadSchema: struct<user_id:bigint,received_at:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(received_at" in text


def test_readiness(spark, folder):
    assert not is_ready(lambda: read_layer(spark, folder, "bronze", "users"))
    assert not is_ready(lambda: spark.range(0))
    assert not is_ready(lambda: spark.read.parquet(f"{folder}/none"))
    assert is_ready(lambda: spark.range(1))


def test_lookup_and_pending(spark, folder):
    spark.range(10).withColumn("v", F.col("id") * 2).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    found = lookup(df, "id", 4)
    assert rows(found) == [(4, 8)] and "EqualTo(id,4)" in plan(found)
    assert rows(pending(df, df.where("id < 8"), "id").select("id")) == [(8,), (9,)]


def test_csv_export(spark, folder):
    segment = spark.createDataFrame(
        [(1, 'a,"b"', "n", 3, 1, date(2024, 1, 30), 1, "low_engagement")],
        "user_id bigint, email string, full_name string, total_pageviews bigint, active_days bigint, last_active_date date, days_since_last_active int, engagement_segment string",
    )
    shuffled = segment.select(*reversed(segment.columns))
    path = export_csv(shuffled, folder, date(2024, 1, 31))
    assert path.endswith("ds=2024-01-31")
    export_csv(shuffled, folder, date(2024, 1, 31))
    text = [open(f).read().splitlines() for f in glob.glob(f"{path}/*.csv")]
    assert all(lines[0] == ",".join(fixed.CSV_SEGMENT_HEADER) for lines in text)
    assert [line for lines in text for line in lines[1:]] == ['1,"a,""b""",n,3,1,2024-01-30,1,low_engagement']


def test_json_events(spark, folder):
    lines = [
        json.dumps({"user_id": 1, "url": "/items/3", "channel": "web", "received_at": "2024-01-01T10:00:00.123456"}),
        json.dumps({"user_id": 2, "url": "/x", "extra": True}),
        '{"user_id": 3, "url": ',
        '{"user_id": "many"}',
    ]
    with open(f"{folder}/a.json", "w") as f:
        f.write("\n".join(lines))
    df = read_json_events(spark, folder, PAGEVIEW_EVENT)
    assert df.schema == PAGEVIEW_EVENT and df.count() == 4
    assert df.where("user_id = 1").first().received_at == ts("2024-01-01 10:00:00.123456")
    good, bad = quarantine_json(spark, folder, PAGEVIEW_EVENT)
    assert rows(good.select("user_id")) == [(1,), (2,)]
    assert rows(bad) == [(lines[3],), (lines[2],)] or rows(bad) == sorted([(lines[2],), (lines[3],)], key=repr)


def test_jdbc_options():
    cut = KeyRange("id", 1, 1_000, 8)
    options = jdbc_read_options("jdbc:x:y", "users", cut, user="u")
    assert {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "user")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8", "user": "u",
    }
    assert "partitionColumn" not in jdbc_read_options("jdbc:x:y", "users")
    write = jdbc_write_options("jdbc:x:y", "recs", connections=4)
    assert write["truncate"] == "true" and write["numPartitions"] == "4"


def test_decimal_overflow_raises_on_write(spark, folder):
    df = spark.createDataFrame(
        [(1, "n", "c", Decimal("123456789.00"), 1, ts("2024-01-01"), ts("2024-01-01"))],
        "id bigint, name string, category string, price decimal(12,2), inventory int, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        overwrite_partitions(df, folder, "bronze", "items")


def test_layers_are_created_once(spark, folder):
    made = init_layers(spark, folder)
    assert set(made) == set(LAYOUTS)
    overwrite_partitions(views(spark, (1, "2024-01-01 01:00:00")), folder, "bronze", "pageviews")
    assert init_layers(spark, folder) == []
    assert read_layer(spark, folder, "bronze", "pageviews").count() == 1
    empty = read_layer(spark, folder, "silver", "purchases_enriched")
    assert read_dimension(spark, folder, "silver", "users", ["id", "email"]).columns == ["id", "email"]
    assert empty.count() == 0 and empty.schema.names == LAYOUTS["silver.purchases_enriched"].schema.names


def test_views(spark, folder):
    overwrite_partitions(views(spark, (1, "2024-01-01 01:00:00"), (2, "2024-01-02 01:00:00")), folder, "bronze", "pageviews")
    assert register_views(spark, folder, ["bronze.pageviews"]) == ["bronze_pageviews"]
    df = spark.sql("select user_id from bronze_pageviews where received_at_day >= date'2024-01-02'")
    assert rows(df) == [(2,)] and "PartitionFilters: [isnotnull(received_at_day" in plan(df)


ITEM = "id bigint, name string, category string, price decimal(7,2), inventory int, created_at timestamp_ntz, updated_at timestamp_ntz"


def items(spark, *data):
    day = ts("2024-01-01")
    return spark.createDataFrame([(i, n, c, Decimal("1.00"), 1, day, ts(f"2024-01-{d:02d}")) for i, n, c, d in data], ITEM)


def stored_items(spark, folder):
    return rows(read_layer(spark, folder, "bronze", "items").select("id", "name", "category"))


def test_merge_moves_rows_between_partitions(spark, folder):
    merge = lambda *data: merge_rows(items(spark, *data), folder, "bronze", "items")
    assert merge((1, "a", "x", 1), (2, "b", "x", 1), (3, "c", "y", 1), (4, "d", "z [1]%", 1), (5, "e", None, 1)).rows == 5
    reader = read_layer(spark, folder, "bronze", "items")
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/bronze/items/**/*.parquet", recursive=True)}
    # 1 moves to a new category, 3 leaves y empty, 5 gets a category, 6 is new without one; of two rows of 6 the newer counts.
    report = merge((1, "a", "w", 2), (3, "c", "x", 2), (5, "e2", "x", 2), (6, "old", "w", 2), (6, "new", None, 3))
    assert report.rows == 5  # with row 2, which shares a partition with 1's old copy
    want = [(1, "a", "w"), (2, "b", "x"), (3, "c", "x"), (4, "d", "z [1]%"), (5, "e2", "x"), (6, "new", None)]
    assert stored_items(spark, folder) == want
    # Nothing that was there has changed, and a reader of the first version still has its rows.
    assert files == {f: os.stat(f).st_mtime_ns for f in files} and reader.count() == 5
    assert not any("z " in f or "category=y" in f for f in glob.glob(f"{folder}/bronze/items/v000001/*"))
    merge((4, "d2", "z [1]%", 4), (5, "e3", "z [1]%", 4))
    assert stored_items(spark, folder) == [*want[:3], (4, "d2", "z [1]%"), (5, "e3", "z [1]%"), want[5]]
    text = plan(read_layer(spark, folder, "bronze", "items").where("category = 'w'"))
    assert "PartitionFilters: [isnotnull(category" in text


def test_empty_writes_change_nothing(spark, folder):
    merge_rows(items(spark, (1, "a", "x", 1)), folder, "bronze", "items")
    nothing = items(spark, (1, "a", "x", 1)).limit(0)
    for write in (merge_rows, overwrite_partitions):
        assert write(nothing, folder, "bronze", "items").rows == 0
    assert stored_items(spark, folder) == [(1, "a", "x")] and numbered(spark, f"{folder}/bronze/items") == [0]
    reviews = spark.createDataFrame([(1, "fine", date(2024, 1, 1))], "review_id bigint, review string, date date")
    assert overwrite_partitions(reviews, folder, "silver", "reviews").rows == 1
    assert overwrite_partitions(reviews.limit(0), folder, "silver", "reviews").rows == 0
    assert merge_rows(reviews.limit(0), folder, "silver", "reviews", "review_id", "date").rows == 0
    assert read_layer(spark, folder, "silver", "reviews").count() == 1
    changed = reviews.withColumn("review", F.lit("better")).unionByName(reviews.withColumn("review_id", F.lit(2).cast("bigint")))
    assert merge_rows(changed, folder, "silver", "reviews", "review_id", "date").rows == 2
    assert rows(read_layer(spark, folder, "silver", "reviews").select("review_id", "review")) == [(1, "better"), (2, "fine")]


def test_versions_that_share_partitions(spark, folder, monkeypatch):
    monkeypatch.setattr("tidemill.sinks.tables.MOST_VERSIONS", 3)
    table = f"{folder}/bronze/items"
    merge = lambda *data: merge_rows(items(spark, *data), folder, "bronze", "items")
    merge(*[(i, "a", f"c{i}", 1) for i in range(4)])
    merge((1, "b", "c1", 2))
    append(items(spark, (9, "n", "c1", 2), (8, "n", "c0", 2)), folder, "bronze", "items")
    want = [(0, "a", "c0"), (1, "b", "c1"), (2, "a", "c2"), (3, "a", "c3"), (8, "n", "c0"), (9, "n", "c1")]
    assert stored_items(spark, folder) == want
    assert [p[-1] for p in drop_old_versions(spark, folder, "bronze", "items", keep=1)] == ["0", "1"]
    assert stored_items(spark, folder) == want and numbered(spark, table) == [2]
    assert not os.path.exists(f"{table}/v000000/category=c1") and os.path.exists(f"{table}/v000000/category=c2")
    merge((3, "d", "c3", 3))  # rows in four versions: written as a whole
    assert stored_items(spark, folder) == [*want[:3], (3, "d", "c3"), *want[4:]]
    assert not os.path.exists(f"{table}/v000004/_parts.json")
    drop_old_versions(spark, folder, "bronze", "items", keep=1)
    assert stored_items(spark, folder) == [*want[:3], (3, "d", "c3"), *want[4:]]
