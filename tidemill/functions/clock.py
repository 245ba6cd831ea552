"""Time functions. ``now`` is always an argument, so that a run can be repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed


def as_ntz(now: datetime | Column) -> Column:
    """A zone-less timestamp literal, independent of the session's and the driver's time zones."""
    if isinstance(now, Column):
        return now.cast("timestamp_ntz")
    return F.expr(f"timestamp_ntz'{now:%Y-%m-%d %H:%M:%S.%f}'")


def day(ts: Column) -> Column:
    return F.to_date(ts)


def days_since(date: Column, now: datetime) -> Column:
    """Whole days from ``date`` to today; NULL for a NULL date."""
    return F.date_diff(as_ntz(now).cast("date"), date)


def in_trailing(ts: Column, now: datetime, interval: str, open_start: bool = False) -> Column:
    """``ts`` at or after ``now - interval``, strictly after with ``open_start``; there is no upper bound."""
    start = as_ntz(now) - F.expr(f"interval {interval}")
    return ts > start if open_start else ts >= start


def last(df: DataFrame, ts: str, now: datetime, interval: str, open_start: bool = False) -> DataFrame:
    """Rows of the trailing interval. If the table is laid out by ``<ts>_day`` the folder is pruned as well."""
    rows = df.where(in_trailing(F.col(ts), now, interval, open_start))
    folder = f"{ts}_day"
    if folder in df.columns:
        rows = rows.where(F.col(folder) >= (as_ntz(now) - F.expr(f"interval {interval}")).cast("date"))
    return rows


def event_time(text: Column, fmt: str = fixed.LOGIN_TS_FORMAT) -> Column:
    """Parse an event's text time; text that does not parse gives NULL."""
    return F.try_to_timestamp(text, F.lit(fmt))


def proc_time() -> Column:
    """Processing time: in a stream, the time of the micro-batch."""
    return F.current_timestamp()


def stamp(df: DataFrame, version: str, now: datetime) -> DataFrame:
    """Add the model version and the time of the run."""
    return df.withColumns({"model_version": F.lit(version), "generated_at": as_ntz(now)})


def with_ingest_ts(df: DataFrame, now: datetime) -> DataFrame:
    return df.withColumn("_ingest_ts", as_ntz(now))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 on the timestamp's own wall clock, whatever the session's time zone."""
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.date_part(F.lit("SECOND"), ts) * 1_000_000
    return minutes * 60_000_000 + seconds.cast("bigint")


def from_micros(us: Column) -> Column:
    """The zone-less timestamp of ``micros``."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=us.cast("decimal(18,0)") / 1_000_000)


def hour_start(ts: Column) -> Column:
    """The full hour a timestamp falls into, zone-less like its input."""
    us = micros(ts)
    return from_micros(us - F.pmod(us, F.lit(3_600_000_000)))
