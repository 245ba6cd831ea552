"""Alert rules over samples: label matchers, thresholds, ratios, combined rules, and holding for a while."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill import fixed
from tidemill.functions.clock import from_micros, micros
from tidemill.operators.series import deriv, finite, SECOND, sum_by

_OPS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


def compare(value: Column, op: str, bound: float) -> Column:
    return _OPS[op](value, F.lit(bound))


def threshold(df: DataFrame, op: str, bound: float, value: str = "value") -> DataFrame:
    """Samples on the alerting side of the bound; what is no number is on neither side."""
    return df.where(compare(F.col(value), op, bound) & ~F.isnan(F.col(value).cast("double")))


def ratio(a: DataFrame, b: DataFrame, on: list[str], value: str = "value") -> DataFrame:
    """``a / b`` where both have a sample with the same labels and time; division by zero gives NULL."""
    top = a.select(*on, F.col(value).cast("double").alias("__a"))
    bottom = b.select(*on, F.col(value).cast("double").alias("__b"))
    return top.join(bottom, on).select(*on, F.try_divide("__a", "__b").alias(value))


def match_labels(df: DataFrame, labels: str | None = None, **matchers: str | tuple[str, str]) -> DataFrame:
    """Series whose labels match: ``name="x"`` equals; ``name=("!=", "x")``, ``("=~", regex)``, ``("!~", regex)``.

    Patterns must match the whole label. A missing label counts as the empty string. Labels are columns, or entries of
    the map column named by ``labels``.
    """
    for name, wanted in matchers.items():
        op, text = ("=", wanted) if isinstance(wanted, str) else wanted
        source = F.col(name) if labels is None else F.try_element_at(F.col(labels), F.lit(name))
        actual = F.coalesce(source.cast("string"), F.lit(""))
        if op in ("=", "!="):
            test = actual == F.lit(text)
        elif op in ("=~", "!~"):
            test = actual.rlike(f"^(?:{text})$")
        else:
            raise ValueError(f"unknown matcher {op}")
        df = df.where(~test if op.startswith("!") else test)
    return df


def lag_growing(
    df: DataFrame, labels: list[str], ts: str = "ts", value: str = "value", bound: float = fixed.LAG_BOUND, window: int = 300
) -> DataFrame:
    """Times at which the summed lag is above the bound and rising: its slope over the window is positive.

    Values that are missing or not finite are left out of the sums.
    """
    total = sum_by(df.where(finite(F.col(value))), labels, ts, value).withColumn(value, F.col(value).cast("double"))
    slope = deriv(total, labels, ts, value, window)
    return threshold(total, ">", bound, value).join(slope.where(F.col("deriv") > 0), [*labels, ts])


def sustained(
    df: DataFrame, labels: list[str], ts: str, condition: Column, hold: int, bucket: int = 3_600
) -> DataFrame:
    """Alerts: runs of samples of a series for which the condition held for ``hold`` seconds or more.

    One row per alert: when the condition began to hold, the first sample at which the alert fires, the last sample of
    the run, and its number of samples. Samples on which the condition is NULL do not hold.

    Runs are found per series and time bucket, and continued across buckets through one summary row per bucket, so a
    series of any length is spread over many tasks.
    """
    us, part, start = "__us", "__bucket", "__start"
    width = bucket * SECOND
    samples = (
        df.select(*labels, micros(F.col(ts)).alias(us), F.coalesce(condition, F.lit(False)).alias("on"))
        .withColumn(part, F.floor(F.col(us) / width).cast("bigint"))
    )
    within = Window.partitionBy(*labels, part).orderBy(us)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.col("on") & ~F.coalesce(F.lag("on").over(within), F.lit(False))
    runs = (
        samples.withColumn("begin", F.when(begins, F.col(us)))
        .withColumn("breaks", F.count_if(~F.col("on")).over(so_far))
        .withColumn(start, F.last("begin", ignorenulls=True).over(so_far))
    )
    # What each bucket hands on: whether anything broke in it, and where the run at its start and at its end began.
    last_on = F.max(F.when(F.col("on"), F.struct(us, start)))
    last_off = F.max(F.when(~F.col("on"), F.col(us)))
    summary = runs.groupBy(*labels, part).agg(
        F.max("breaks").alias("breaks"), last_on.alias("last_on"), last_off.alias("last_off"), F.min("begin").alias("first")
    )
    broke = F.col("breaks") > 0
    open_end = F.col(f"last_on.{us}") > F.coalesce(F.col("last_off"), F.lit(-(2**62)))
    by_bucket = Window.partitionBy(*labels).orderBy(part)
    carried = (
        summary.withColumn("segment", F.count_if(broke).over(by_bucket))
        .withColumn("open_since", F.when(broke, F.when(open_end, F.col(f"last_on.{start}"))).otherwise(F.col("first")))
        .withColumn(
            "open_since", F.min("open_since").over(Window.partitionBy(*labels, "segment").orderBy(part))
        )
        .withColumn("carry", F.lag("open_since").over(by_bucket))
        .select(*[F.col(c).alias(f"__{c}") for c in labels], F.col(part).alias("__part"), "carry")
    )
    same = F.col(part) == F.col("__part")
    for c in labels:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    began = F.when(F.col("breaks") == 0, F.coalesce("carry", start)).otherwise(F.col(start))
    holding = runs.where("on").join(carried, same, "left").select(*labels, us, began.alias(start))
    alerts = holding.groupBy(*labels, start).agg(
        F.min(F.when(F.col(us) >= F.col(start) + hold * SECOND, F.col(us))).alias("fires"),
        F.max(us).alias("ends"),
        F.count(F.lit(1)).alias("samples"),
    )
    return alerts.where(F.col("fires").isNotNull()).select(
        *labels,
        from_micros(F.col(start)).alias("active_at"),
        from_micros(F.col("fires")).alias("fired_at"),
        from_micros(F.col("ends")).alias("last_seen"),
        "samples",
    )


@dataclass(frozen=True)
class RelabelRule:
    """A pattern for a whole raw name, and templates with ``$1``, ``$2`` for its groups."""

    pattern: str
    name: str
    labels: tuple[tuple[str, str], ...] = ()


def _template(raw: Column, pattern: str, text: str) -> Column:
    pieces, rest = [], text
    while "$" in rest:
        before, _, rest = rest.partition("$")
        pieces += [F.lit(before)] if before else []
        pieces.append(F.regexp_extract(raw, pattern, int(rest[0])))
        rest = rest[1:]
    pieces += [F.lit(rest)] if rest else []
    return F.concat(*pieces) if pieces else F.lit("")


def relabel(df: DataFrame, rules: list[RelabelRule], raw: str = "raw", anchored: bool = False) -> DataFrame:
    """Turn raw metric names into a name and labels by the first rule that matches; rows without a rule are dropped.

    A pattern may match anywhere in the raw name, or must match all of it if ``anchored``. Adds ``metric`` (lower case) and the map ``labels`` (names in lower case, values as they are).
    """
    source = F.col(raw)
    name, labels = None, None
    for rule in rules:
        whole = f"^(?:{rule.pattern})$" if anchored else rule.pattern
        hit = source.rlike(whole)
        metric = F.lower(_template(source, whole, rule.name))
        pairs = [x for key, text in rule.labels for x in (F.lit(key.lower()), _template(source, whole, text))]
        entry = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
        name = F.when(hit, metric) if name is None else name.when(hit, metric)
        labels = F.when(hit, entry) if labels is None else labels.when(hit, entry)
    return df.withColumns({"metric": name, "labels": labels}).where(F.col("metric").isNotNull())


def fire(name: str, severity: str, runs: DataFrame, labels: list[str]) -> DataFrame:
    """Alerts of one rule in a shape all rules share, so that they can be kept in one table.

    ``runs`` comes from ``sustained``; its labels go into the map ``labels``.
    """
    pairs = [x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]
    return runs.select(
        F.lit(name).alias("alert"),
        F.lit(severity).alias("severity"),
        (F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")).alias("labels"),
        "active_at",
        "fired_at",
        "last_seen",
        "samples",
    )
