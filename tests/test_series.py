from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tidemill.operators import alerts, series
from tidemill.operators.alerts import RelabelRule

START = datetime(2024, 1, 1)


def samples(seed=1, n=400, hot=0.6):
    """Irregular samples of four series, one of which holds most; counters restart now and then."""
    rng, data, seen = random.Random(seed), [], set()
    level = dict.fromkeys("abcd", 0)
    for i in sorted(rng.sample(range(20_000), n)):
        name = "a" if rng.random() < hot else rng.choice("bcd")
        level[name] = rng.randrange(3) if rng.random() < 0.1 else level[name] + rng.randrange(10)
        at = START + timedelta(seconds=i, microseconds=rng.choice([0, 1, 999_999]))
        if (name, at) not in seen:
            seen.add((name, at))
            data.append((name, at, float(level[name])))
    # samples exactly one window apart, and on a bucket's edge
    data += [("edge", START + timedelta(seconds=s), float(s)) for s in (0, 300, 600, 1200, 1500, 1501)]
    return data


@pytest.fixture(scope="module")
def metric(spark):
    data = samples()
    return data, spark.createDataFrame(data, "name string, ts timestamp_ntz, value double").repartition(3).cache()


def windows(data, w):
    for name, at, _ in data:
        inside = sorted((t, v) for n, t, v in data if n == name and at - timedelta(seconds=w) < t <= at)
        yield name, at, inside


def close(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, rel=1e-6, abs=1e-9)), key


def by_key(df, column):
    return {(r["name"], r["ts"]): r[column] for r in df.collect()}


@pytest.mark.parametrize("bucket", [None, 300, 7_000])
def test_increase_and_rate(metric, bucket):
    data, df = metric
    want = {}
    for name, at, inside in windows(data, 300):
        steps = [b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:])]
        want[name, at] = sum(steps) if steps else None
    close(by_key(series.increase(df, ["name"], "ts", "value", 300, bucket), "increase"), want)
    close(
        by_key(series.rate(df, ["name"], "ts", "value", 300, bucket), "rate"),
        {k: None if v is None else v / 300 for k, v in want.items()},
    )


@pytest.mark.parametrize("bucket", [None, 300])
def test_delta_and_deriv(metric, bucket):
    data, df = metric
    delta, slope = {}, {}
    for name, at, inside in windows(data, 300):
        many = len(inside) > 1
        delta[name, at] = (inside[-1][1] - inside[0][1]) / 5 if many else None
        x = [(t - START).total_seconds() for t, _ in inside]
        slope[name, at] = float(np.polyfit(np.array(x) - x[0], [v for _, v in inside], 1)[0]) if many else None
    close(by_key(series.delta(df, ["name"], "ts", "value", 300, per=60, bucket=bucket), "delta"), delta)
    close(by_key(series.deriv(df, ["name"], "ts", "value", 300, bucket=bucket), "deriv"), slope)


def test_window_is_open_at_its_start(metric):
    got = by_key(series.delta(metric[1], ["name"], "ts", "value", 300), "delta")
    edge = {(at - START).total_seconds(): v for (n, at), v in got.items() if n == "edge"}
    assert edge == {0: None, 300: None, 600: None, 1200: None, 1500: None, 1501: 1.0}


def test_series_is_cut_by_time_and_shuffled_once(metric):
    text = plan(series.increase(metric[1], ["name"], "ts", "value", 300), "simple")
    assert text.count("Exchange hashpartitioning(name") == 1 and "__bucket" in text


def test_bucket_must_cover_the_window(metric):
    with pytest.raises(ValueError, match="bucket"):
        series.increase(metric[1], ["name"], "ts", "value", 300, bucket=299)


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_are_exact(spark, accuracy):
    rng = random.Random(5)
    data = [(g, START + timedelta(minutes=i % 150), float(v)) for g, n in (("hot", 900), ("few", 3)) for i in range(n) for v in [rng.choice([1, 1, 1, rng.randrange(500)])]]
    df = spark.createDataFrame([*data, ("few", START, None)], "name string, ts timestamp_ntz, value double")
    qs = (0.0, 0.5, 0.9, 0.99, 1.0)
    want = set()
    for key in {(g, t.replace(minute=0)) for g, t, _ in data}:
        values = sorted(v for g, t, v in data if (g, t.replace(minute=0)) == key)
        want |= {(*key, q, values[max(int(np.ceil(q * len(values))), 1) - 1]) for q in qs}
    assert {tuple(r) for r in series.quantiles(df, ["name"], "ts", "value", qs, accuracy=accuracy).collect()} == want


def test_sums(spark):
    df = spark.createDataFrame([("g", "t1", 0, 1, 2.0), ("g", "t1", 1, 1, 3.0), ("g", "t2", 0, 1, 5.0)], "grp string, topic string, part int, ts int, value double")
    assert rows(series.sum_by(df, ["grp"])) == [("g", 1, 10.0)]
    assert rows(series.sum_without(df, ["part"])) == [("g", "t1", 1, 5.0), ("g", "t2", 1, 5.0)]


def alerts_by_hand(data, hold):
    found = []
    for name in {n for n, _, _ in data}:
        run = []
        for at, on in [*sorted((t, bool(o)) for n, t, o in data if n == name), (None, False)]:
            if on:
                run.append(at)
                continue
            fired = [t for t in run if t >= run[0] + timedelta(seconds=hold)]
            if fired:
                found.append((name, run[0], fired[0], run[-1], len(run)))
            run = []
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bucket", [60, 600, 86_400])
def test_sustained(spark, seed, bucket):
    rng, data = random.Random(seed), []
    for name in "ab":
        on, at = True, START + timedelta(seconds=rng.randrange(30))
        for _ in range(150):
            on = on if rng.random() < 0.93 else not on
            data.append((name, at, None if not on and rng.random() < 0.3 else on))
            at += timedelta(seconds=rng.choice([1, 15, 15, 15, 200]))
    df = spark.createDataFrame(data, "name string, ts timestamp_ntz, v boolean")
    got = alerts.sustained(df, ["name"], "ts", F.col("v"), hold=120, bucket=bucket)
    assert rows(got) == alerts_by_hand(data, 120)


def test_thresholds_ratio_and_matchers(spark):
    df = spark.createDataFrame([("a", 1, 9.0), ("b", 1, 10.0), (None, 1, 0.0)], "name string, ts int, value double")
    assert rows(alerts.threshold(df, "!=", 9.0).select("value")) == [(0.0,), (10.0,)]
    assert rows(alerts.match_labels(df, name="a").select("name")) == [("a",)]
    assert rows(alerts.match_labels(df, name=("!=", "a")).select("name")) == [("b",), (None,)]
    assert rows(alerts.match_labels(df, name=("=~", "a|bb")).select("name")) == [("a",)]
    assert rows(alerts.match_labels(df, name=("!~", ".*b")).select("name")) == [("a",), (None,)]
    a, b = (alerts.match_labels(df, name=n).drop("name") for n in "ab")
    assert rows(alerts.threshold(alerts.ratio(a, b, ["ts"]), ">", 0.85)) == [(1, 0.9)]
    assert alerts.ratio(b, alerts.match_labels(df, name="").drop("name"), ["ts"]).first().value is None
    labelled = df.select("value", F.create_map(F.lit("topic"), "name").alias("l"))
    assert rows(alerts.match_labels(labelled, labels="l", topic="b").select("value")) == [(10.0,)]


def test_lag_growing(spark):
    data = [("g", p, START + timedelta(seconds=15 * i), 100.0 * i if p else 4000.0) for i in range(40) for p in (0, 1)]
    df = spark.createDataFrame(data, "grp string, part int, ts timestamp_ntz, value double")
    got = alerts.lag_growing(df, ["grp"], bound=5000).collect()
    assert sorted((r.ts - START).seconds // 15 for r in got) == list(range(11, 40))
    assert got[0].deriv == pytest.approx(100 / 15)


def test_relabel(spark):
    rules = [RelabelRule(r"a<t=(\w+)><>Value", "A_$1"), RelabelRule(r"a<t=(\w+)><>(Rate|Value)", "x_$2_y", (("Kind", "$1"),))]
    df = spark.createDataFrame([("a<t=One><>Value",), ("a<t=Two><>Rate",), ("xa<t=Two><>Rate",)], "raw string")
    whole = {"a<t=One><>Value": ("a_one", {}), "a<t=Two><>Rate": ("x_rate_y", {"kind": "Two"})}
    got = {r.raw: (r.metric, r.labels) for r in alerts.relabel(df, rules, anchored=True).collect()}
    assert got == whole
    got = {r.raw: (r.metric, r.labels) for r in alerts.relabel(df, rules).collect()}
    assert got == whole | {"xa<t=Two><>Rate": ("x_rate_y", {"kind": "Two"})}


def finite_windows(data, w):
    """Every row's window over finite samples, in the order of time and value."""
    for name, at, _ in data:
        yield name, at, sorted((t, v) for n, t, v in data if n == name and at - timedelta(seconds=w) < t <= at and v is not None and np.isfinite(v))


@pytest.mark.parametrize("bucket", [None, 60, 500])
def test_gaps_and_peers(spark, bucket):
    rng = random.Random(11)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    data = [(rng.choice("ab"), START + timedelta(seconds=rng.randrange(400)), rng.choice([*odd, *[float(rng.randrange(9)) for _ in range(9)]])) for _ in range(300)]
    data += [("gaps", START + timedelta(seconds=s), rng.choice(odd)) for s in range(9)] + [("one", START, 3.0), ("one", START, 5.0), ("late", START, None)]
    data += [("late", START + timedelta(seconds=70), 1.0)]
    df = spark.createDataFrame(data, "name string, ts timestamp_ntz, value double").repartition(3)
    want = {"increase": {}, "delta": {}, "deriv": {}}
    for name, at, inside in finite_windows(data, 60):
        two, values = len(inside) >= 2, [v for _, v in inside]
        times = [(t - START).total_seconds() for t, _ in inside]
        steps = sum(b - a if b >= a else b for a, b in zip(values, values[1:]))
        want["increase"][name, at] = steps if two else None
        want["delta"][name, at] = values[-1] - values[0] if two else None
        want["deriv"][name, at] = np.polyfit(times, values, 1)[0] if two and len(set(times)) > 1 else None
    for name, made in (("increase", series.increase), ("delta", series.delta), ("deriv", series.deriv)):
        got = made(df, ["name"], "ts", "value", 60, bucket=bucket)
        assert got.count() == len(data)
        close(by_key(got, name), want[name])


def test_thresholds_over_what_is_no_number(spark):
    df = spark.createDataFrame([("a", START, v) for v in (1.0, 9.0, None, float("nan"), float("inf"))], "name string, ts timestamp_ntz, value double")
    assert sorted(r.value for r in alerts.threshold(df, ">", 5).collect()) == [9.0, float("inf")]
    rising = [("a", START + timedelta(seconds=i), v) for i, v in enumerate([6.0, None, float("nan"), 8.0, 9.0])]
    df = spark.createDataFrame(rising, "name string, ts timestamp_ntz, value double")
    assert [r.value for r in alerts.lag_growing(df, ["name"], bound=5, window=60).orderBy("ts").collect()] == [8.0, 9.0]
