from __future__ import annotations

import contextlib
import io
from datetime import datetime

from pyspark.sql import DataFrame


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
