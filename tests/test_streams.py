from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows, ts
from tidemill.operators import sales
from tidemill.schemas import LOGIN_EVENT, PURCHASE_EVENT, declared
from tidemill.sources import read_changes, read_event_stream
from tidemill.streaming import changes as keyed
from tidemill.streaming import logins, purchases, runner


def write_lines(folder, name, objects):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}.tmp", "w") as f:
        f.write("\n".join(json.dumps(o) for o in objects))
    os.rename(f"{folder}/.{name}.tmp", f"{folder}/{name}")


def login(user, at, device):
    return {"user_id": user, "login_ts": at, "ip_address": "10.0.0.1", "device": device, "is_success": True}


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(1, "Ann", "Lee", "ann@x.org"), (2, None, "Poe", "poe@x.org")], "id bigint, first_name string, last_name string, email string"
    )


def burst(user, minute, n, devices):
    return [login(user, f"2024-01-01 00:{minute:02d}:{i:02d}.500", f"d{i % devices}") for i in range(n)]


CASES = [
    *burst(1, 0, 6, 3),  # an alert
    *burst(2, 0, 5, 3),  # too few logins
    *burst(1, 2, 9, 2),  # too few devices
    *burst(7, 3, 7, 7),  # an unknown user: an alert without e-mail
    login(1, "2024-01-01 00:05:59.999", "a"), *burst(1, 6, 5, 5),  # a window's edge splits six logins
    login(1, "not a time", "a"),
]


def alerts(df):
    return rows(df.select("user_id", "user_email", "window_start", "window_end", "login_count", "distinct_devices"))


WANT = [
    (1, "ann@x.org", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:00"), 6, 3),
    (7, None, ts("2024-01-01 00:03:00"), ts("2024-01-01 00:04:00"), 7, 7),
]


def test_alerts_on_a_table(spark, users):
    df = spark.createDataFrame([json.dumps(c) for c in CASES], "string").select(F.from_json("value", LOGIN_EVENT).alias("e")).select("e.*")
    assert alerts(logins.login_alerts(df, users)) == WANT


def test_alerts_on_a_stream_equal_those_on_the_table(spark, users, folder):
    write_lines(f"{folder}/in", "a.json", [*CASES, login(0, "2024-03-01 00:00:00.000", "end")])
    stream = read_event_stream(spark, f"{folder}/in", LOGIN_EVENT)
    runner.run_append(logins.login_alerts(stream, users), f"{folder}/out", f"{folder}/ck")
    assert alerts(spark.read.parquet(f"{folder}/out")) == WANT


def test_late_logins_are_dropped_and_restart_goes_on(spark, users, folder):
    def run():
        stream = read_event_stream(spark, f"{folder}/in", LOGIN_EVENT)
        runner.run_append(logins.login_alerts(stream, users), f"{folder}/out", f"{folder}/ck")
        return alerts(spark.read.parquet(f"{folder}/out"))

    write_lines(f"{folder}/in", "a.json", burst(1, 0, 4, 4))
    run()
    write_lines(f"{folder}/in", "b.json", [*burst(1, 0, 3, 3), login(0, "2024-01-01 00:30:00.000", "x")])
    assert run() == [(1, "ann@x.org", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:00"), 7, 4)]
    # after the watermark has passed: too late, so neither a second alert nor a changed one
    write_lines(f"{folder}/in", "c.json", [*burst(1, 0, 9, 9), login(0, "2024-01-01 01:30:00.000", "x")])
    assert len(run()) == 1


def test_two_jobs_over_one_source(spark, users, folder):
    write_lines(f"{folder}/in", "a.json", [*CASES, login(0, "2024-03-01 00:00:00.000", "end")])

    def source():
        return read_event_stream(spark, f"{folder}/in", LOGIN_EVENT)

    jobs = [
        runner.Job("enrich", lambda: logins.enrich_logins(source(), users), f"{folder}/enriched", f"{folder}/ck1"),
        runner.Job("alert", lambda: logins.login_alerts(source(), users), f"{folder}/alerts", f"{folder}/ck2"),
    ]
    runner.await_all(runner.start_jobs(jobs))
    enriched = spark.read.json(f"{folder}/enriched")
    assert enriched.count() == len(CASES) + 1
    assert rows(enriched.where("user_id in (1, 2)").select("user_id", "full_name").distinct()) == [(1, "Ann Lee"), (2, None)]
    assert spark.read.json(f"{folder}/alerts").count() == 2


def buy(number, item, quantity, at, **more):
    return {"user_id": number, "item_id": item, "quantity": quantity, "purchase_price": 2.5, "created_at": at, **more}


def test_ingest_fills_defaults_and_a_replayed_batch_replaces_itself(spark, folder):
    write_lines(f"{folder}/in", "a.json", [buy(1, 9, 2, "2024-01-30T12:00:00"), buy(2, 8, 1, "2024-01-30T12:30:00", deleted=True)])
    defaults = {"id": 0, "campaign_id": "", "status": 1, "deleted": False}

    def stream():
        return read_event_stream(spark, f"{folder}/in", PURCHASE_EVENT, defaults=defaults, files_per_batch=1)

    purchases.ingest_append(stream(), f"{folder}/t", f"{folder}/ck")
    write_lines(f"{folder}/in", "b.json", [buy(3, 9, 4, "2024-01-30T13:00:00")])
    purchases.ingest_append(stream(), f"{folder}/t", f"{folder}/ck")
    table = spark.read.parquet(f"{folder}/t").drop("batch")
    assert rows(table.select("id", "item_id", "quantity", "campaign_id", "deleted")) == [
        (0, 8, 1, "", True), (0, 9, 2, "", False), (0, 9, 4, "", False)
    ]
    # without its progress the stream takes the same batches again, into the same folders
    purchases.ingest_append(stream(), f"{folder}/t", f"{folder}/ck-lost")
    table = spark.read.parquet(f"{folder}/t").drop("batch")
    assert table.count() == 3
    now = ts("2024-01-31 00:00:00")
    assert rows(sales.hourly_volume(table, now)) == [(ts("2024-01-30 12:00:00"), 2), (ts("2024-01-30 13:00:00"), 4)]
    assert rows(sales.flash_top_items(table)) == [(8, 1, Decimal("2.50")), (9, 6, Decimal("15.00"))]


def test_running_volume_emits_hours_that_are_over(spark, folder):
    data = [buy(1, 9, 2, f"2024-01-30T{h:02d}:10:00", deleted=h == 11) for h in (10, 11, 12, 12, 20)]
    write_lines(f"{folder}/in", "a.json", data)
    stream = read_event_stream(spark, f"{folder}/in", PURCHASE_EVENT)
    runner.run_append(purchases.stream_hourly_volume(stream), f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out")) == [(ts("2024-01-30 10:00:00"), 2), (ts("2024-01-30 12:00:00"), 4)]


def test_stream_dedup(spark, folder):
    schema = declared("id bigint, event_time timestamp_ntz")
    for name in ("a.json", "b.json"):
        write_lines(f"{folder}/in", name, [{"id": i, "event_time": f"2024-01-01T00:00:0{i}"} for i in (1, 2, 2)])
    stream = read_event_stream(spark, f"{folder}/in", schema, files_per_batch=1)
    runner.run_append(runner.stream_dedup(stream, ["id"]).select("id"), f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out")) == [(1,), (2,)]


def test_since_skips_older_files(spark, folder):
    schema = declared("id bigint")
    write_lines(f"{folder}/in", "old.json", [{"id": 1}])
    write_lines(f"{folder}/in", "new.json", [{"id": 2}])
    long_ago = (datetime.now() - timedelta(days=9)).timestamp()
    os.utime(f"{folder}/in/old.json", (long_ago, long_ago))
    since = datetime.now(timezone.utc) - timedelta(days=1)
    runner.run_append(read_event_stream(spark, f"{folder}/in", schema, since=since), f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out")) == [(2,)]


IMAGE = declared("id bigint, price money(7)")


def change(seq, op, key, price):
    image = {"id": key, "price": price}
    return {"op": op, "seq": seq, "ts": "2024-01-01T00:00:00", "before": image if op == "d" else None, "after": None if op == "d" else image}


def test_keyed_table_over_batches_replay_and_fold(spark, folder):
    root = f"{folder}/t"

    def take(checkpoint="ck"):
        keyed.apply_stream(read_changes(spark, f"{folder}/in", IMAGE, "id", files_per_batch=1), root, f"{folder}/{checkpoint}", "id")
        return [(r.id, r.price) for r in sorted(keyed.read_state(spark, root, "id").collect(), key=lambda r: r.id)]

    with pytest.raises(FileNotFoundError):
        keyed.read_state(spark, root, "id")
    write_lines(f"{folder}/in", "a.json", [change(1, "c", 1, "1.00"), change(2, "c", 2, "2.00"), change(3, "u", 1, "1.50")])
    assert take() == [(1, Decimal("1.50")), (2, Decimal("2.00"))]
    write_lines(f"{folder}/in", "b.json", [change(5, "d", 2, "2.00"), change(6, "c", 3, "3.00")])
    assert take() == [(1, Decimal("1.50")), (3, Decimal("3.00"))]
    assert keyed.fold(spark, root, "id") == 1
    # older than the delete that the base holds: must not bring key 2 back
    write_lines(f"{folder}/in", "c.json", [change(4, "u", 2, "9.00"), change(7, "u", 3, "3.50")])
    assert take() == [(1, Decimal("1.50")), (3, Decimal("3.50"))]
    keyed.fold(spark, root, "id")
    assert keyed.fold(spark, root, "id") == 2
    assert rows(keyed.read_state(spark, root, "id").select("id")) == [(1,), (3,)]
