"""Operators over labelled samples (labels.., ts, value): increase, rate, delta, deriv, sums, quantiles.

They compare the samples inside the window ``(t - w, t]`` that ends at each sample, without extrapolating to the
window's edges. A window with fewer than two samples gives NULL.

A row whose value is missing, not a number or infinite is a gap: it counts as no sample, and its own result is that of the samples
in its window. Samples of one series and time are peers: they come in the order of their values, all of them lie in a window
that ends at their time, and so they have one result.

A series may hold a large part of all samples, so no operator here puts a whole series into one task. Time is cut into
buckets, each bucket also gets copies of the samples that lie up to one window before it, and windows are computed per
series and bucket. The copies are dropped again, and every result is exactly that of the uncut series.

A window may also hold very many samples, and Spark evaluates a sliding frame anew for every row. So the results are
differences of running totals instead: each sample is paired with the first sample of its window, which one pass over
the bucket finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.clock import from_micros, micros

_US, _HOME, _BUCKET = "__us", "__home", "__bucket"
SECOND = 1_000_000
BUCKET_WINDOWS = 4


def _cut(df: DataFrame, labels: list[str], ts: str, value: str, window: int, width: int) -> DataFrame:
    """Assign samples to time buckets, and to the next bucket too if its windows reach back to them."""
    if width < window * SECOND:
        raise ValueError("a bucket must be at least as long as the window")
    timed = df.select(*labels, ts, F.col(value).alias("__v"), micros(F.col(ts)).alias(_US))
    homed = timed.withColumn(_HOME, F.floor(F.col(_US) / width).cast("bigint"))
    reaches_next = F.pmod(F.col(_US), F.lit(width)) > width - window * SECOND
    buckets = F.when(reaches_next, F.array(F.col(_HOME), F.col(_HOME) + 1)).otherwise(F.array(F.col(_HOME)))
    return homed.withColumn(_BUCKET, F.explode(buckets))


def finite(value: Column) -> Column:
    """Whether a value is a sample: there, a number and not infinite."""
    number = value.cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")), F.lit(False))


def _ends(
    df: DataFrame, labels: list[str], ts: str, value: str, window: int, bucket: int | None, totals: dict[str, Column]
) -> DataFrame:
    """Every row with what the running ``totals`` are at its last peer (``last``) and at its window's first sample (``first``).

    ``totals`` are expressions over the sample's value ``__v``, the value before it ``__before`` (NULL for the bucket's
    first) and the seconds since the bucket began ``__x``; each is summed up along the bucket's samples, gaps left out. Both structs
    also hold the number of samples ``n``, the value ``v`` and the seconds ``t``.
    """
    width = (bucket or BUCKET_WINDOWS * window) * SECOND
    along = Window.partitionBy(*labels, _BUCKET).orderBy(_US, F.col("__v").asc_nulls_first())
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    seconds = (F.col(_US) - F.col(_BUCKET) * F.lit(width)).cast("double") / SECOND
    cut = _cut(df, labels, ts, value, window, width)
    # A gap's value is NULL from here on.
    placed = cut.withColumn("__v", F.when(finite(F.col("__v")), F.col("__v"))).withColumns(
        {"__before": F.last("__v", ignorenulls=True).over(earlier), "__x": seconds}
    )
    sample = F.col("__v").isNotNull()
    sums = {f"__sum_{name}": F.sum(F.when(sample, total)).over(running) for name, total in totals.items()}
    summed = placed.withColumns({"__n": F.count("__v").over(running), "__seen": F.last("__v", ignorenulls=True).over(running), **sums})
    state = F.struct(
        F.col("__n").alias("n"),
        F.col("__seen").alias("v"),
        F.col("__x").alias("t"),
        *[F.coalesce(F.col(f"__sum_{name}"), F.lit(0)).alias(name) for name in totals],
    )
    # The state at the last of the peers has counted the most samples.
    peers = Window.partitionBy(*labels, _BUCKET, _US)
    marked = summed.withColumn("__state", state).withColumn("__last", F.max("__state").over(peers))
    # Each row also places a mark at the (open) start of its window. Backwards in time, the sample seen last before
    # reaching the mark is the window's first one; of the samples of one time the last one is seen first.
    none = F.lit(None)
    point = F.struct(F.col(_US).alias("at"), F.lit(1).alias("kind"), F.col("__state").alias("seen"), none.alias("last"))
    mark = F.struct(
        (F.col(_US) - window * SECOND).alias("at"), F.lit(0).alias("kind"), none.alias("seen"), F.col("__last").alias("last")
    )
    home = F.when(F.col(_BUCKET) == F.col(_HOME), F.array(mark)).otherwise(F.array())
    both = F.when(sample, F.concat(F.array(point), home)).otherwise(home)
    backwards = (
        Window.partitionBy(*labels, _BUCKET)
        .orderBy(F.col("e.at").desc(), F.col("e.kind").asc(), F.col("e.seen.n").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    points = marked.select(*labels, ts, _BUCKET, F.explode(both).alias("e"))
    paired = points.withColumn("first", F.last("e.seen", ignorenulls=True).over(backwards)).where(F.col("e.kind") == 0)
    return paired.select(*labels, ts, F.col("e.last").alias("last"), "first")


def _growth(name: str) -> Column:
    return F.col(f"last.{name}") - F.col(f"first.{name}")


def _two() -> Column:
    """At least two samples in the window. Without any, the first sample seen lies after the row and has counted more."""
    return _growth("n") >= 1


def increase(df: DataFrame, labels: list[str], ts: str, value: str, window: int, bucket: int | None = None) -> DataFrame:
    """Growth of a counter over ``window`` seconds: the sum of its steps, where a drop means it restarted from 0."""
    v, before = F.col("__v"), F.col("__before")
    step = F.when(before.isNull(), F.lit(0)).when(v >= before, v - before).otherwise(v)
    ends = _ends(df, labels, ts, value, window, bucket, {"steps": step})
    return ends.select(*labels, ts, F.when(_two(), _growth("steps")).alias("increase"))


def rate(df: DataFrame, labels: list[str], ts: str, value: str, window: int, bucket: int | None = None) -> DataFrame:
    """Increase per second of the window."""
    grown = increase(df, labels, ts, value, window, bucket)
    return grown.select(*labels, ts, (F.col("increase") / F.lit(float(window))).alias("rate"))


def delta(
    df: DataFrame, labels: list[str], ts: str, value: str, window: int, per: int | None = None, bucket: int | None = None
) -> DataFrame:
    """Last minus first value of a gauge in the window; with ``per``, scaled to that many seconds."""
    change = _growth("v") if per is None else _growth("v") / F.lit(window / per)
    ends = _ends(df, labels, ts, value, window, bucket, {})
    return ends.select(*labels, ts, F.when(_two(), change).alias("delta"))


def deriv(df: DataFrame, labels: list[str], ts: str, value: str, window: int, bucket: int | None = None) -> DataFrame:
    """Slope per second of the least-squares line through the window's samples."""
    x, y = F.col("__x"), F.col("__v").cast("double")
    ends = _ends(df, labels, ts, value, window, bucket, {"x": x, "y": y, "xy": x * y, "xx": x * x})
    # A growth leaves out the first sample itself; add it back.
    t, v, n = F.col("first.t"), F.col("first.v").cast("double"), _growth("n") + 1
    sx, sy, sxy, sxx = _growth("x") + t, _growth("y") + v, _growth("xy") + t * v, _growth("xx") + t * t
    slope = F.try_divide(sxy - sx * sy / n, sxx - sx * sx / n)
    return ends.select(*labels, ts, F.when(_two(), slope).alias("deriv"))


def sum_by(df: DataFrame, labels: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Sum of the values per time over all series that agree in ``labels``."""
    return df.groupBy(*labels, ts).agg(F.sum(value).alias(value))


def sum_without(df: DataFrame, drop: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Sum of the values per time over the series that differ only in the dropped labels."""
    return sum_by(df, [c for c in df.columns if c not in (*drop, ts, value)], ts, value)


def quantiles(
    df: DataFrame,
    labels: list[str],
    ts: str,
    value: str,
    qs: tuple[float, ...] = (0.5, 0.9, 0.99),
    window: int = 3600,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact nearest-rank quantiles per series and tumbling window: the least value with a share of at least q below it.

    A sketch first brackets each quantile within a few ten-thousandths of the group. Values below the bracket are only
    counted, and just the distinct values inside it are put in order, so no group is gathered or sorted whole.
    """
    start = (F.floor(micros(F.col(ts)) / (window * SECOND)) * (window * SECOND)).cast("bigint")
    group = [*labels, _US]
    raw = df.where(F.col(value).isNotNull()).select(*labels, start.alias(_US), F.col(value).alias("v"))
    slack = 4.0 / accuracy
    ends = [end for q in qs for end in (max(0.0, q - slack), min(1.0, q + slack))]
    brackets = raw.groupBy(*group).agg(
        F.percentile_approx("v", ends, accuracy).alias("ends"), F.count(F.lit(1)).alias("total")
    )
    wanted = [
        F.struct(
            F.lit(q).alias("q"),
            F.get("ends", F.lit(2 * i)).alias("low"),
            F.get("ends", F.lit(2 * i + 1)).alias("high"),
            F.greatest(F.ceil(F.lit(q) * F.col("total")), F.lit(1)).alias("rank"),
        )
        for i, q in enumerate(qs)
    ]
    targets = brackets.select(*group, F.explode(F.array(*wanted)).alias("t")).select(*group, "t.*")
    counts = raw.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("n"))
    # Values below the bracket fold into one row with a NULL value, which sorts first; values above it are not needed.
    kept = (
        counts.join(targets, group)
        .where(F.col("v") <= F.col("high"))
        .groupBy(*group, "q", "rank", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v"))
        .agg(F.sum("n").alias("n"))
    )
    so_far = F.sum("n").over(Window.partitionBy(*group, "q").orderBy(F.col("v").asc_nulls_first()))
    hit = (F.col("so_far") >= F.col("rank")) & (F.col("so_far") - F.col("n") < F.col("rank"))
    return kept.withColumn("so_far", so_far).where(hit).select(
        *labels, from_micros(F.col(_US)).alias("window_start"), "q", F.col("v").alias("value")
    )
