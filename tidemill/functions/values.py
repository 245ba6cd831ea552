"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import fixed


def clamp_non_negative(value: Column, to: str | T.DataType) -> Column:
    """Negative values become 0, NULL stays NULL, and the type is kept at ``to``."""
    return F.when(value < 0, F.lit(0)).otherwise(value).cast(to)


def total_price(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast("decimal(14,2)")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 when there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def engagement_segment(
    views: Column,
    days: Column,
    high: tuple[int, int] = (fixed.HIGH_MIN_VIEWS, fixed.HIGH_MAX_DAYS),
    medium: tuple[int, int, int] = (fixed.MEDIUM_MIN_VIEWS, fixed.MEDIUM_MAX_VIEWS, fixed.MEDIUM_MAX_DAYS),
) -> Column:
    """High: many views and recent. Medium: some views and fairly recent. Low: all others, also the never active."""
    is_high = (views >= high[0]) & (days <= high[1])
    is_medium = views.between(medium[0], medium[1]) & (days <= medium[2])
    return F.when(is_high, fixed.HIGH).when(is_medium, fixed.MEDIUM).otherwise(fixed.LOW)
