"""Login streams: profile lookup, and alerts on many logins from many devices in a short time.

The same functions run on a finished table of logins and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions import event_time, full_name_strict
from tidemill.streaming.lookup import enrich_stream
from tidemill.streaming.runner import with_event_time


_ENRICHED = ("user_id", "user_email", "full_name", "login_ts", "ip_address", "device", "is_success")
_ALERT = ("user_id", "user_email", "window_start", "window_end", "login_count", "distinct_devices", "alert_type")


def profiles(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"),
        F.col("email").alias("user_email"),
        full_name_strict(F.col("first_name"), F.col("last_name")).alias("full_name"),
    )


def enrich_logins(logins: DataFrame, users: DataFrame) -> DataFrame:
    """Logins with the user's e-mail and name; logins of unknown users are kept, with NULLs.

    On a stream the users are those of its start; ``enrich_logins_live`` follows them.
    """
    return logins.join(profiles(users), "user_id", "left").select(*_ENRICHED)


def enrich_logins_live(logins: DataFrame, users: Callable[[], DataFrame], root: str, checkpoint: str) -> str:
    """A stream of logins with e-mail and name as they are when a batch is taken, written to the table at ``root``."""
    return enrich_stream(logins, lambda: profiles(users()), "user_id", root, checkpoint, lambda df: df.select(*_ENRICHED))


def login_bursts(
    logins: DataFrame,
    window: str = fixed.ALERT_WINDOW,
    min_logins: int = fixed.ALERT_MIN_LOGINS,
    min_devices: int = fixed.ALERT_MIN_DEVICES,
    delay: str = fixed.LOGIN_WATERMARK,
) -> DataFrame:
    """Users with more than ``min_logins`` logins from more than ``min_devices`` devices in a tumbling window.

    Logins are counted per device first and devices per user second. Both steps keep one row per group as state, so a
    user under attack from ever new devices never becomes one growing set, and streams, which refuse distinct counts,
    run the same plan as tables. Each step adds up inside its tasks before it shuffles, and devices lie all over the first step's
    partitions: the one task that keeps a user's window receives one row from each of them, however many logins the user has.
    On a stream a window is emitted once, when the watermark passes its end.
    """
    timed = logins.withColumn("event_time", event_time(F.col("login_ts")))
    if logins.isStreaming:
        timed = with_event_time(timed, "event_time", delay)
    else:
        # Without a zone the windows of a table start on its own wall clock, whatever the session's zone.
        timed = timed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).where("event_time is not null")
    per_device = timed.groupBy(F.window("event_time", window).alias("w"), "user_id", "device").agg(F.count(F.lit(1)).alias("logins"))
    per_user = per_device.groupBy("w", "user_id").agg(
        F.sum("logins").alias("login_count"), F.count("device").alias("distinct_devices")
    )
    hits = per_user.where((F.col("login_count") > min_logins) & (F.col("distinct_devices") > min_devices))
    return hits.select(
        "user_id",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "login_count",
        "distinct_devices",
        F.lit(fixed.ALERT_TYPE).alias("alert_type"),
    )


def login_alerts(logins: DataFrame, users: DataFrame, **limits) -> DataFrame:
    """The bursts of ``login_bursts`` with the user's e-mail, NULL for unknown users.

    Only alerts are looked up, not logins, so the users' table meets few rows and no user's logins meet in a join.
    """
    return login_bursts(logins, **limits).join(profiles(users).drop("full_name"), "user_id", "left").select(*_ALERT)


def login_alerts_live(logins: DataFrame, users: Callable[[], DataFrame], root: str, checkpoint: str, **limits) -> str:
    """A stream of alerts, each with the user's e-mail as it is when the alert is raised, written to the table at ``root``."""
    known = lambda: profiles(users()).drop("full_name")
    return enrich_stream(login_bursts(logins, **limits), known, "user_id", root, checkpoint, lambda df: df.select(*_ALERT))
