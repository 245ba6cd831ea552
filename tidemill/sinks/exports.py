"""Dated CSV exports for people outside the lakehouse."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tidemill import fixed


def export_csv(df: DataFrame, folder: str, ds: date, header: list[str] | None = None) -> str:
    """Write the columns of ``header``, in its order, to ``folder/ds=<date>``; a rerun replaces that date.

    Each task writes its own file with a header line; nothing is gathered in one process. Quotes are doubled.
    """
    target = f"{folder.rstrip('/')}/ds={ds:%Y-%m-%d}"
    columns = header or fixed.CSV_SEGMENT_HEADER
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(target)
    return target
