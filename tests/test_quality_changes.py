from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from tidemill.operators import changes as cdc
from tidemill.operators import quality, sales
from tidemill.plans import medallion
from tidemill.plans.frames import NOW, frame
from tidemill.schemas import declared
from tidemill.sources import read_layer, unwrap
from tidemill.sources.versions import numbered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def purchases(spark):
    return spark.createDataFrame(
        [(1, 1, Decimal("5.00")), (None, 0, Decimal("-1.00")), (3, None, None)], "id bigint, quantity int, purchase_price decimal(12,2)"
    )


def test_rules_ignore_null_values(purchases):
    got = {(r.rule, r.column_name): (r.total, r.unexpected, r.success) for r in quality.BRONZE_SUITES["purchases"].results(purchases).collect()}
    assert got == {
        ("not_null", "id"): (3, 1, False), ("between", "quantity"): (3, 1, False), ("between", "purchase_price"): (3, 1, False),
    }


def test_one_scan_per_suite(purchases):
    assert plan(quality.BRONZE_SUITES["purchases"].results(purchases), "simple").count("Scan ") == 1


def test_split_names_the_broken_rules(purchases):
    good, bad = quality.BRONZE_SUITES["purchases"].split(purchases)
    assert rows(good.select("id")) == [(1,), (3,)]
    assert bad.first().broken_rules == ["not_null(id)", "between(quantity)", "between(purchase_price)"]


def test_regex_is_searched_for_and_types_and_counts(spark):
    df = spark.createDataFrame([("x@y", "1"), ("none", "a"), (None, None)], "email string, n string")
    suite = quality.Suite(
        "s", (quality.matches("email", "@"), quality.of_type("n", "int"), quality.of_type("email", "string"), quality.row_count(4), quality.row_count(max=3))
    )
    assert [r.unexpected for r in suite.results(df).collect()] == [1, 1, 0, 1, 0]
    assert suite.results(df.limit(0)).first().success


def test_gate_lists_all_failures(purchases, spark):
    report = quality.quality_report(
        {"users": spark.createDataFrame([(1, "bad")], "id bigint, email string"), "purchases": purchases},
        {k: quality.BRONZE_SUITES[k] for k in ("users", "purchases")},
    )
    with pytest.raises(quality.GateFailed) as stop:
        quality.gate(report)
    assert len(stop.value.failures) == 4 and "bronze_users: matches(email)" in str(stop.value)
    quality.gate(report.where("success"))


def test_flow_stops_before_silver_on_bad_rows(spark, folder):
    sources = {n: frame(spark, SF, n) for n in medallion.BRONZE}
    with pytest.raises(quality.GateFailed):
        medallion.run_batch(spark, sources, folder, NOW)
    assert read_layer(spark, folder, "quality", "report").where("not success").count() == 3
    with pytest.raises(FileNotFoundError):
        read_layer(spark, folder, "silver", "users")


def test_flow_runs_twice_without_doubling(spark, folder):
    sources = {n: quality.BRONZE_SUITES[n].split(frame(spark, SF, n))[0] for n in medallion.BRONZE}
    first = medallion.run_batch(spark, sources, folder, NOW, export_to=f"{folder}/export")
    again = medallion.run_batch(spark, sources, folder, NOW, export_to=f"{folder}/export")
    assert first.rows() == again.rows()
    assert first.rows()["silver.users"] == sources["users"].count()
    assert spark.read.option("header", True).csv(first.csv_path).count() == first.rows()["gold.user_engagement_segments"]


def test_documented_cleaning_and_version_expiry(spark, folder):
    sources = {n: quality.BRONZE_SUITES[n].split(frame(spark, SF, n))[0] for n in medallion.BRONZE}
    users = sources["users"]
    twin = users.orderBy("id").limit(1)
    shout = twin.withColumns({"id": F.lit(10**9), "email": F.upper("email"), "updated_at": F.col("updated_at") + F.expr("interval 90 days")})
    sources["users"] = users.unionByName(shout)
    for _ in range(2):
        medallion.run_batch(spark, sources, folder, NOW, clean=True, keep=1)
    stored = read_layer(spark, folder, "silver", "users")
    assert stored.count() == users.count() and stored.where("id = 1000000000").count() == 1
    assert stored.where("email <> lower(email)").count() == 0
    bought, orphans = sources["purchases"], read_layer(spark, folder, "quality", "orphans")
    kept = read_layer(spark, folder, "silver", "purchases_enriched")
    assert kept.count() + orphans.count() == bought.count() and orphans.count() > 0
    assert kept.where("item_name is null").count() == 0
    for table in ("bronze/users", "silver/items", "gold/top_selling_items", "quality/report"):
        assert len(numbered(spark, f"{folder}/{table}")) == 1


IMAGE = declared("id bigint, inventory int, price money(7)")


def test_unwrap_deletes_keep_their_key(spark):
    lines = [
        {"op": "c", "seq": 1, "ts": "2024-01-01T00:00:00.000001", "before": None, "after": {"id": 5, "inventory": 2, "price": "1.50"}},
        {"op": "d", "seq": 2, "ts": "2024-01-01T00:00:01", "before": {"id": 5, "inventory": 2, "price": "1.50"}, "after": None},
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    assert rows(unwrap(df, IMAGE, "id")) == [
        ("c", 1, ts("2024-01-01 00:00:00.000001"), 5, 2, Decimal("1.50")), ("d", 2, ts("2024-01-01 00:00:01"), 5, None, None)
    ]


def make_changes(spark, n=400, keys=25, seed=3):
    rng = random.Random(seed)
    data = [(i, rng.randrange(keys), rng.choice("ccuuud"), rng.randrange(100)) for i in range(n)]
    return data, spark.createDataFrame(data, "seq bigint, id bigint, op string, inventory int")


def final(data):
    state = {}
    for seq, key, op, value in data:
        state[key] = (seq, key, op, value)
    return sorted((v for v in state.values() if v[2] != "d"), key=repr)


def test_latest_state(spark):
    data, df = make_changes(spark)
    latest = cdc.latest_state(df, "id")
    assert rows(latest) == final(data)
    assert "WindowGroupLimit" in plan(latest)


@pytest.mark.parametrize("threshold", ["-1", "10m"])  # the state is shuffled, or filtered where it lies
@pytest.mark.parametrize("order", ["forward", "backward", "mixed"])
def test_apply_in_any_order_and_twice(spark, order, threshold):
    data, df = make_changes(spark)
    cuts = {"forward": [0, 150, 250, 400], "backward": [250, 400, 0, 250], "mixed": [100, 300, 0, 400]}[order]
    batches = [df.where(f"seq >= {a} and seq < {b}") for a, b in zip(cuts[::2], cuts[1::2])]
    if order == "forward":
        batches = [df.where("seq < 150"), df.where("seq >= 150 and seq < 250"), df.where("seq >= 250"), df.where("seq >= 150")]
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        state = cdc.newest_change(batches[0], "id")
        for batch in batches[1:]:
            state = cdc.apply_changes(state, batch, "id")
        assert rows(cdc.live(state)) == final(data)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_apply_with_ties_and_missing_keys_or_sequences(spark, threshold):
    shape = "seq bigint, id bigint, v int"
    state = spark.createDataFrame([(5, 1, 10), (7, 2, 20), (None, 3, 30), (1, None, 40), (9, 4, 50)], shape)
    batch = spark.createDataFrame([(5, 1, 3), (None, 2, 21), (None, 3, 31), (2, None, 41), (3, None, 42), (8, 4, 51), (1, 5, 60)], shape)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.id: (r.seq, r.v) for r in cdc.apply_changes(state, batch, "id").collect()}
        assert cdc.apply_changes(state, batch, "id").count() == len(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert got == {1: (5, 3), 2: (7, 20), 3: (None, 31), None: (3, 42), 4: (9, 50), 5: (1, 60)}


def test_small_batch_does_not_shuffle_the_state(spark, folder):
    _, df = make_changes(spark)
    cdc.newest_change(df, "id").write.parquet(f"{folder}/state")
    df.where("seq > 390").write.parquet(f"{folder}/batch")
    text = plan(cdc.apply_changes(spark.read.parquet(f"{folder}/state"), spark.read.parquet(f"{folder}/batch"), "id"), "simple")
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_as_of_and_changed_columns(spark):
    df = spark.createDataFrame(
        [(1, 7, "c", 1, ts("2024-01-01")), (2, 7, "u", 2, ts("2024-01-02")), (3, 7, "d", None, ts("2024-01-03"))],
        "seq bigint, id bigint, op string, v int, ts timestamp_ntz",
    )
    at = {d: [r.v for r in cdc.as_of(df, "id", ts(d)).collect()] for d in ("2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03")}
    assert at == {"2023-12-31": [], "2024-01-01": [1], "2024-01-02": [2], "2024-01-03": []}
    images = spark.createDataFrame([((1, None), (1, 2)), ((1, None), (1, None))], "before struct<a:int,b:int>, after struct<a:int,b:int>")
    assert [r.changed for r in cdc.changed_columns(images, ["a", "b"]).collect()] == [["b"], []]


def test_flash_metrics_count_versions_unless_reduced(spark):
    df = spark.createDataFrame(
        [(1, 1, "u", 10, 2, Decimal("3.00")), (2, 1, "u", 10, 5, Decimal("3.00")), (3, 2, "u", 10, 1, Decimal("1.00")), (4, 2, "d", 10, 1, Decimal("1.00"))],
        "seq bigint, id bigint, op string, item_id bigint, quantity int, purchase_price decimal(12,2)",
    )
    assert rows(sales.flash_top_items(df)) == [(10, 9, Decimal("23.00"))]
    assert rows(sales.flash_top_items(cdc.latest_state(df, "id"))) == [(10, 5, Decimal("15.00"))]
