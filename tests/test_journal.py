"""Tables that several checkpoints write, merge and read."""

from __future__ import annotations

import os

import pytest

from helpers import rows
from test_streams import IMAGE, buy, change, write_lines
from tidemill.schemas import PURCHASE_EVENT
from tidemill.sources import read_changes, read_event_stream
from tidemill.sources.journal import Journal, Merged, Part, digest, observed_write, ranges
from tidemill.streaming import changes as keyed
from tidemill.streaming import purchases


def test_ranges():
    assert ranges([]) == [] and ranges([3, 1, 2, 7, 7]) == [[1, 3], [7, 7]]
    assert Merged(0, {1: [[0, 3]]}).has(Part(1, 2)) and not Merged(0, {1: [[0, 3]]}).has(Part(0, 2))


def test_digest_depends_on_rows_not_on_their_order(spark, folder):
    one = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "a int, `b.c` string")
    told = [observed_write(df, f"{folder}/{i}") for i, df in enumerate([one, one.orderBy("a").repartition(3), one.distinct(), one.limit(0)])]
    assert told[0] == told[1] != told[2] and told[3] == ""
    assert spark.read.parquet(f"{folder}/0").count() == 3


def test_a_part_counts_once_it_is_marked(spark, folder):
    log = Journal(spark, folder, "p-")

    def fails(path, part):
        raise RuntimeError(path)

    with pytest.raises(RuntimeError):
        log.land("q", 0, fails)
    assert log.live() == ([], [])
    write = lambda text: lambda path, part: digest(text)
    assert [log.land("q", b, write(b)) for b in (0, 1)] == [Part(0, 0), Part(0, 1)]
    assert log.land("q", 1, write("other rows")) == Part(0, 1)  # replayed: replaces itself
    assert log.land("r", 0, write(0)) is None  # another run, the same rows
    assert log.land("r", 1, write(1)) == Part(1, 1)  # the rows of a part that has been replaced
    assert log.land("r", 2, lambda path, part: "") == Part(1, 2)  # an empty batch is no one's copy
    assert log.land("q", 2, lambda path, part: "") == Part(0, 2)
    parts, merged = log.live()
    assert parts == [Part(0, 0), Part(0, 1), Part(0, 2), Part(1, 1), Part(1, 2)] and merged == []

    first = log.merge(parts[:2], [], lambda path: None)
    assert log.live() == (parts[2:], [first]) and first.covers == {0: [[0, 1]]}
    assert log.land("q", 1, fails) is None  # replayed after it was merged
    second = log.merge(parts[2:4], [first], lambda path: None)
    assert second.level == 2 and log.live() == ([Part(1, 2)], [second])
    log.expire()
    assert log.live() == ([Part(1, 2)], [second]) and log.state()[1] == [second]
    assert log.land("s", 5, write(0)) is None  # known although its data are gone


def test_checkpoints_do_not_hide_each_other(spark, folder):
    root = f"{folder}/t"

    def take(source, checkpoint):
        stream = read_changes(spark, f"{folder}/{source}", IMAGE, "id", files_per_batch=1)
        keyed.apply_stream(stream, root, f"{folder}/{checkpoint}", "id")
        return [(r.id, float(r.price)) for r in sorted(keyed.read_state(spark, root, "id").collect(), key=lambda r: r.id)]

    write_lines(f"{folder}/a", "1.json", [change(1, "c", 1, "1.00"), change(2, "c", 2, "2.00")])
    assert take("a", "ck1") == [(1, 1.0), (2, 2.0)]
    assert keyed.fold(spark, root, "id") == 0
    # A second checkpoint counts from 0 again; its batch is not behind the base.
    write_lines(f"{folder}/b", "1.json", [change(5, "u", 1, "1.50"), change(6, "c", 3, "3.00")])
    assert take("b", "ck2") == [(1, 1.5), (2, 2.0), (3, 3.0)]
    keyed.fold(spark, root, "id")
    # The first one goes on with its batch 1 after a base was made that covers only its batch 0.
    write_lines(f"{folder}/a", "2.json", [change(7, "d", 2, "2.00")])
    assert take("a", "ck1") == [(1, 1.5), (3, 3.0)]
    # Its progress is lost: all of its batches come again, one of them older than the base.
    assert take("a", "ck3") == [(1, 1.5), (3, 3.0)]
    keyed.fold(spark, root, "id")
    assert len(keyed.expire(spark, root)) >= 3 and keyed.expire(spark, root) == []
    assert take("a", "ck4") == [(1, 1.5), (3, 3.0)]
    assert sorted(n for n in os.listdir(root) if not n.startswith(("_", "."))) == ["delta-m-2"]


def test_ingest_under_several_checkpoints(spark, folder):
    def take(source, checkpoint):
        stream = read_event_stream(spark, f"{folder}/{source}", PURCHASE_EVENT, files_per_batch=1)
        purchases.ingest_append(stream, f"{folder}/t", f"{folder}/{checkpoint}")
        return [r[0] for r in rows(purchases.read_ingested(spark, f"{folder}/t").select("user_id"))]

    assert purchases.read_ingested(spark, f"{folder}/t").count() == 0
    assert purchases.compact_ingested(spark, f"{folder}/t") is None
    write_lines(f"{folder}/a", "1.json", [buy(1, 9, 2, "2024-01-30T12:00:00")] * 2)
    write_lines(f"{folder}/b", "1.json", [buy(2, 9, 2, "2024-01-30T12:00:00")])
    assert take("a", "ck1") == [1, 1]
    assert take("b", "ck2") == [1, 1, 2]  # also a batch 0
    purchases.compact_ingested(spark, f"{folder}/t")
    assert take("b", "ck3") == [1, 1, 2]  # lost progress
    write_lines(f"{folder}/b", "2.json", [buy(3, 9, 2, "2024-01-30T12:00:00")])
    assert take("b", "ck2") == take("b", "ck3") == [1, 1, 2, 3]
    purchases.compact_ingested(spark, f"{folder}/t")
    purchases.journal(spark, f"{folder}/t").expire()
    assert take("a", "ck4") == [1, 1, 2, 3]
