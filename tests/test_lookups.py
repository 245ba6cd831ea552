"""Lookups of the dimension as it is now, and alerts for a user with half of all logins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from test_streams import login, write_lines
from tidemill.schemas import LOGIN_EVENT
from tidemill.sources import read_event_stream
from tidemill.streaming import logins, lookup, runner

USER = "id bigint, first_name string, last_name string, email string"


def users(spark, **emails):
    return spark.createDataFrame([(int(k[1:]), "A", "B", e) for k, e in emails.items()], USER)


def test_look_up_keeps_unknown_keys_and_copies(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, w string")
    assert rows(lookup.look_up(facts, dim, "k").select("v", "w")) == [("a", "x"), ("b", "x"), ("c", None), ("d", None)]
    assert lookup.look_up(facts.limit(0), dim, "k").count() == 0


def test_each_batch_sees_the_profiles_of_its_time(spark, folder):
    known = {"u1": "old@x.org", "u2": "two@x.org"}
    asked = []

    def now():
        asked.append(dict(known))
        return users(spark, **known)

    def take(checkpoint="ck"):
        stream = read_event_stream(spark, f"{folder}/in", LOGIN_EVENT, files_per_batch=1)
        logins.enrich_logins_live(stream, now, f"{folder}/t", f"{folder}/{checkpoint}")
        return rows(lookup.read_enriched(spark, f"{folder}/t").select("user_id", "user_email"))

    with pytest.raises(FileNotFoundError):
        lookup.read_enriched(spark, f"{folder}/t")
    write_lines(f"{folder}/in", "a.json", [login(1, "2024-01-01 00:00:00.000", "d"), login(9, "2024-01-01 00:00:00.000", "d")])
    assert take() == [(1, "old@x.org"), (9, None)]
    known.update(u1="new@x.org", u9="nine@x.org")
    del known["u2"]
    write_lines(f"{folder}/in", "b.json", [login(1, "2024-01-01 00:01:00.000", "d"), login(2, "2024-01-01 00:01:00.000", "d")])
    assert take() == [(1, "new@x.org"), (1, "old@x.org"), (2, None), (9, None)]
    assert len(asked) == 2
    # The same logins again, under a new checkpoint and other profiles: nothing is added or changed.
    assert take("lost") == [(1, "new@x.org"), (1, "old@x.org"), (2, None), (9, None)]


HOT = [login(1, f"2024-01-01 00:00:{i % 60:02d}.{i:03d}", f"d{i % 250}") for i in range(500)]
REST = [login(2 + i % 100, f"2024-01-01 00:00:{i % 60:02d}.000", f"d{i}") for i in range(500)]
WINDOW = (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:00"))


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_user_with_half_of_all_logins(spark, folder, no_broadcast):
    write_lines(f"{folder}/in", "a.json", [*HOT, *REST, login(0, "2024-03-01 00:00:00.000", "end")])
    known = users(spark, **{f"u{i}": f"{i}@x.org" for i in range(200)})
    columns = ["user_id", "user_email", "window_start", "window_end", "login_count", "distinct_devices"]
    want = [(1, "1@x.org", *WINDOW, 500, 250)]
    table = spark.read.schema(LOGIN_EVENT).json(f"{folder}/in")
    assert rows(logins.login_alerts(table, known).select(*columns)) == want
    stream = read_event_stream(spark, f"{folder}/in", LOGIN_EVENT)
    runner.run_append(logins.login_alerts(stream, known), f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out").select(*columns)) == want


def test_logins_are_added_up_before_they_are_shuffled_and_only_alerts_are_looked_up(spark, no_broadcast):
    table = spark.createDataFrame([], LOGIN_EVENT).withColumn("device", F.upper("device"))
    text = plan(logins.login_alerts(table, users(spark, u1="1@x.org")), "simple")
    alerts = text[text.index("SortMergeJoin") :] if "SortMergeJoin" in text else text
    steps = [line for line in alerts.splitlines() if "HashAggregate" in line or "Exchange" in line or "SortAggregate" in line]
    kinds = ["partial" if "partial_" in s else "exchange" if "Exchange" in s else "final" for s in steps]
    # From the join down: users' step, devices' step; each adds up on both sides of its shuffle.
    assert kinds[:7] == ["exchange", "final", "exchange", "partial", "final", "exchange", "partial"]
