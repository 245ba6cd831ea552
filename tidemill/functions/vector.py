"""Vector functions on array columns, summed in double precision and in element order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """The vector scaled to length 1; a zero vector has no direction and gives NULL."""
    size = norm(a)
    return F.when(size > 0, F.transform(a, lambda x: x.cast("double") / size))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of the angle; NULL if either vector is all zero."""
    sizes = norm(a) * norm(b)
    return F.when(sizes > 0, F.lit(1.0) - dot(a, b) / sizes)


def similarity(distance: Column) -> Column:
    return F.lit(1.0) - distance


def similarity_text(distance: Column) -> Column:
    """Similarity with four decimals, as shown to a reader."""
    return F.format_string("%.4f", similarity(distance))
