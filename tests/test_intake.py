"""Events with bad lines, late rows and fields left out."""

from __future__ import annotations

import os

import pytest

from helpers import rows
from test_streams import buy, write_lines
from tidemill.schemas import PURCHASE_EVENT
from tidemill.sources import read_event_stream
from tidemill.sources.events import CORRUPT
from tidemill.streaming import intake


def test_bad_and_late_rows_are_set_aside(spark, folder):
    def take(checkpoint="ck"):
        stream = read_event_stream(spark, f"{folder}/in", PURCHASE_EVENT, files_per_batch=1, defaults={"id": 0, "status": 1, "deleted": False}, corrupt=True)
        assert stream.columns == [*PURCHASE_EVENT.names, CORRUPT]
        intake.take_in(stream, f"{folder}/t", f"{folder}/{checkpoint}", "created_at", "1 hour")
        return [rows(intake.read_taken(spark, f"{folder}/t", k).select(c)) for k, c in (("rows", "user_id"), ("late", "user_id"), ("bad", "line"))]

    with pytest.raises(FileNotFoundError):
        intake.read_taken(spark, f"{folder}/t")
    with pytest.raises(ValueError):
        intake.read_taken(spark, f"{folder}/t", "other")
    # Within the first batch nothing is late.
    write_lines(f"{folder}/in", "a.json", [buy(1, 9, 2, "2024-01-30T12:00:00"), buy(2, 9, 2, "2024-01-30T02:00:00"), {"user_id": "x", "quantity": 7}])
    assert take() == [[(1,), (2,)], [], [('{"user_id": "x", "quantity": 7}',)]]
    # The newest is 12:00: an hour late is in time, more is not; rows without a time are taken; a late row moves nothing.
    write_lines(
        f"{folder}/in", "b.json",
        [buy(3, 9, 1, "2024-01-30T11:00:00"), buy(4, 9, 1, "2024-01-30T10:59:59"), buy(5, 9, 1, None), buy(6, 9, 1, "2024-01-30T15:00:00")],
    )
    with open(f"{folder}/in/c.json", "w") as f:
        f.write('{"user_id": 7, "item\n\n{"user_id": 8, "created_at": "2024-01-30T13:59:59"}\n')
    os.utime(f"{folder}/in/c.json", (2_000_000_000, 2_000_000_000))
    want = [[(1,), (2,), (3,), (5,), (6,)], [(4,), (8,)], [('{"user_id": "x", "quantity": 7}',), ('{"user_id": 7, "item',)]]
    assert take() == want
    # Progress lost: every batch comes again and adds nothing.
    assert take("lost") == want
    stored = intake.read_taken(spark, f"{folder}/t")
    assert stored.columns == PURCHASE_EVENT.names
    assert rows(stored.where("user_id = 1").select("id", "status", "deleted", "campaign_id")) == [(0, 1, False, None)]
