"""Metric and alert queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import alerts, series
from tidemill.operators.alerts import RelabelRule
from tidemill.plans.catalog import Shop, query

LABELS = ["series", "instance"]
SIX_HOURS = 21_600

_FRAME = "partition by series, instance order by ts range between {w} preceding and current row"
# The window is open at its start: (t - w, t].
_W6 = _FRAME.format(w="interval '21599.999999 seconds'")


@query(
    f"""with s as (select *, lag(counter) over (partition by series, instance order by ts) as b from metrics),
            t as (select *, case when b is null then 0 when counter >= b then counter - b else counter end as step from s)
       select series, instance, ts, case when count(*) over w >= 2 then sum(step) over w - first(step) over w end as increase
       from t window w as ({_W6})""",
    ("metrics",),
)
def metric_increase(shop: Shop) -> DataFrame:
    return series.increase(shop.frame("metrics"), LABELS, "ts", "counter", SIX_HOURS)


@query(
    f"""with s as (select *, lag(counter) over (partition by series, instance order by ts) as b from metrics),
            t as (select *, case when b is null then 0 when counter >= b then counter - b else counter end as step from s)
       select series, instance, ts,
              round(case when count(*) over w >= 2 then sum(step) over w - first(step) over w end / 21600, 9) as rate
       from t window w as ({_W6})""",
    ("metrics",),
)
def metric_rate(shop: Shop) -> DataFrame:
    made = series.rate(shop.frame("metrics"), LABELS, "ts", "counter", SIX_HOURS)
    return made.withColumn("rate", F.round("rate", 9))


@query(
    f"""select series, instance, ts,
              round(case when count(*) over w >= 2 then last(gauge) over w - first(gauge) over w end / 360, 6) as delta
       from metrics window w as ({_W6})""",
    ("metrics",),
)
def metric_delta(shop: Shop) -> DataFrame:
    made = series.delta(shop.frame("metrics"), LABELS, "ts", "gauge", SIX_HOURS, per=60)
    return made.withColumn("delta", F.round("delta", 6))


_SECONDS = "(epoch_us(ts) - 1704067200000000) / 1e6"


@query(
    f"""select series, instance, ts, round(case when count(*) over w >= 2 then regr_slope(gauge, {_SECONDS}) over w end, 7) + 0.0
               as deriv
       from metrics window w as ({_W6})""",
    ("metrics",),
)
def metric_deriv(shop: Shop) -> DataFrame:
    made = series.deriv(shop.frame("metrics"), LABELS, "ts", "gauge", SIX_HOURS)
    return made.withColumn("deriv", F.round("deriv", 7) + 0.0)


_OFF_HALVES = 3e-11  # slopes over full hours may end in a 5 that two engines round two ways

# Samples with gaps and peers: positions in the order (time, value), and each time's first and last position in its window.
_GAPS = f"""
    with f as (select series, instance, ts, {{v}} as v, {_SECONDS} as x,
                      row_number() over (partition by series, instance order by ts, {{v}}) as n
               from gaps where {{v}} is not null and isfinite({{v}})),
         d as (select *, case when b is null then 0 when v >= b then v - b else v end as step
               from (select *, lag(v) over (partition by series, instance order by n) as b from f)),
         c as (select *, sum(step) over (partition by series, instance order by n) as total from d),
         t as (select distinct series, instance, ts from gaps),
         r as (select t.series, t.instance, t.ts, min(n) as lo, max(n) as hi, count(n) as samples,
                      regr_slope(f.v, f.x) as slope
               from t left join f on t.series = f.series and t.instance = f.instance and f.ts <= t.ts and f.ts > t.ts - interval 6 hour
               group by all)
    select g.series, g.instance, g.ts, {{result}}
    from gaps g join r on g.series = r.series and g.instance = r.instance and g.ts = r.ts
    left join c a on r.series = a.series and r.instance = a.instance and r.lo = a.n
    left join c z on r.series = z.series and r.instance = z.instance and r.hi = z.n"""


def _over_gaps(value: str, result: str) -> str:
    return _GAPS.format(v=value, result=result)


@query(_over_gaps("counter", "round(case when samples >= 2 then z.total - a.total end, 6) as increase"), ("gaps",))
def metric_increase_gaps(shop: Shop) -> DataFrame:
    """Hourly counters with missing values, NaN and several samples of one time."""
    made = series.increase(shop.frame("gaps"), LABELS, "ts", "counter", SIX_HOURS)
    return made.withColumn("increase", F.round("increase", 6))


@query(_over_gaps("counter", "round(case when samples >= 2 then z.total - a.total end / 21600, 9) as rate"), ("gaps",))
def metric_rate_gaps(shop: Shop) -> DataFrame:
    return series.rate(shop.frame("gaps"), LABELS, "ts", "counter", SIX_HOURS).withColumn("rate", F.round("rate", 9))


@query(_over_gaps("gauge", "round(case when samples >= 2 then z.v - a.v end / 360, 6) + 0.0 as delta"), ("gaps",))
def metric_delta_gaps(shop: Shop) -> DataFrame:
    made = series.delta(shop.frame("gaps"), LABELS, "ts", "gauge", SIX_HOURS, per=60)
    return made.withColumn("delta", F.round("delta", 6) + 0.0)


@query(_over_gaps("gauge", "round(case when samples >= 2 then slope + 3e-11 end, 9) + 0.0 as deriv"), ("gaps",))
def metric_deriv_gaps(shop: Shop) -> DataFrame:
    made = series.deriv(shop.frame("gaps"), LABELS, "ts", "gauge", SIX_HOURS)
    return made.withColumn("deriv", F.round(F.col("deriv") + _OFF_HALVES, 9) + 0.0)


@query(
    """with l as (select series, ts, sum(gauge) as value from gaps where gauge is not null and isfinite(gauge) group by all),
            w as (select l.series, l.ts, l.value, count(*) as samples,
                         regr_slope(k.value, (epoch_us(k.ts) - 1704067200000000) / 1e6) as deriv
                  from l join l k on l.series = k.series and k.ts <= l.ts and k.ts > l.ts - interval 6 hour group by all)
       select series, ts, round(value, 6) as value, round(deriv + 3e-11, 9) as deriv from w where samples >= 2 and value > 300 and deriv > 0""",
    ("gaps",),
)
def alert_lag_growing_gaps(shop: Shop) -> DataFrame:
    """Summed lag that is high and rises, over samples of which some are missing or no numbers."""
    found = alerts.lag_growing(shop.frame("gaps"), ["series"], "ts", "gauge", bound=300, window=SIX_HOURS)
    return found.select("series", "ts", F.round("gauge", 6).alias("value"), F.round(F.col("deriv") + _OFF_HALVES, 9).alias("deriv"))


@query("select series, ts, round(sum(value), 6) as value from lag group by all", ("lag",))
def metric_sum_by(shop: Shop) -> DataFrame:
    return series.sum_by(shop.frame("lag"), ["series"]).withColumn("value", F.round("value", 6))


@query("select series, ts, round(sum(value), 6) as value from lag group by all", ("lag",))
def metric_sum_without(shop: Shop) -> DataFrame:
    return series.sum_without(shop.frame("lag"), ["instance"]).withColumn("value", F.round("value", 6))


@query(
    """with d as (select series, instance, date_trunc('day', ts) as window_start, gauge,
                         row_number() over (partition by series, instance, date_trunc('day', ts) order by gauge) as rn,
                         count(*) over (partition by series, instance, date_trunc('day', ts)) as n from metrics)
       select series, instance, window_start, q, max(gauge) as value
       from d join (values (0.5::double), (0.9::double), (0.99::double)) t(q) on d.rn = ceil(q * n) group by all""",
    ("metrics",),
)
def metric_quantiles(shop: Shop) -> DataFrame:
    return series.quantiles(shop.frame("metrics"), LABELS, "ts", "gauge", window=86_400)


@query("select series, instance, ts, gauge from metrics where gauge > 100", ("metrics",))
def alert_threshold(shop: Shop) -> DataFrame:
    samples = shop.frame("metrics").select(*LABELS, "ts", "gauge")
    return alerts.threshold(samples, ">", 100, "gauge")


@query(
    """select a.series, a.ts, round(a.value / b.value, 6) as value from lag a join lag b on a.series = b.series and a.ts = b.ts
       where a.instance = 0 and b.instance = 1 and a.value / b.value > 0.85""",
    ("lag",),
)
def alert_ratio(shop: Shop) -> DataFrame:
    samples = shop.frame("lag")
    first, second = (alerts.match_labels(samples, instance=i) for i in ("0", "1"))
    high = alerts.threshold(alerts.ratio(first, second, ["series", "ts"]), ">", 0.85)
    return high.withColumn("value", F.round("value", 6))


@query(
    f"""with s as (select series, ts, sum(value) as value from lag group by all),
            d as (select *, case when count(*) over w >= 2 then regr_slope(value, {_SECONDS}) over w end as deriv
                  from s window w as (partition by series order by ts range between
                                      interval '21599.999999 seconds' preceding and current row))
       select series, ts, round(value, 6) as value, round(deriv, 7) as deriv from d where value > 50 and deriv > 0""",
    ("lag",),
)
def alert_lag_growing(shop: Shop) -> DataFrame:
    """High and growing, with a bound that fits the data and a window of six hours."""
    found = alerts.lag_growing(shop.frame("lag"), ["series"], bound=50, window=SIX_HOURS)
    return found.withColumns({"value": F.round("value", 6), "deriv": F.round("deriv", 7)})


@query(
    """with c as (select *, coalesce(gauge > 4, false) as o from metrics),
            r as (select *, count(*) filter (where not o) over (partition by series, instance order by ts) as g from c),
            a as (select series, instance, ts, min(ts) over (partition by series, instance, g) as s, g from r where o)
       select series, instance, s as active_at, min(ts) filter (where ts >= s + interval 1 hour) as fired_at,
              max(ts) as last_seen, count(*) as samples
       from a group by series, instance, g, s having max(ts) >= s + interval 1 hour""",
    ("metrics",),
)
def alert_sustained(shop: Shop) -> DataFrame:
    return alerts.sustained(shop.frame("metrics"), LABELS, "ts", F.col("gauge") > 4, hold=3_600)


def _runs_sql(rule: str, severity: str, source: str, condition: str, hours: int) -> str:
    return f"""
        select '{rule}' as alert, '{severity}' as severity, series, cast(instance as varchar) as instance, s as active_at,
               min(ts) filter (where ts >= s + interval {hours} hour) as fired_at, max(ts) as last_seen, count(*) as samples
        from (select *, min(ts) over (partition by series, instance, g) as s from (
              select *, count(*) filter (where not o) over (partition by series, instance order by ts) as g
              from (select *, coalesce({condition}, false) as o from {source})) where o)
        group by series, instance, g, s having max(ts) >= s + interval {hours} hour"""


@query(
    f"""with s as (select *, lag(counter) over (partition by series, instance order by ts) as b from metrics),
             t as (select *, case when b is null then 0 when counter >= b then counter - b else counter end as step from s),
             i as (select series, instance, ts, case when count(*) over w >= 2 then sum(step) over w - first(step) over w end as x
                   from t window w as ({_W6}))
        {_runs_sql("GrowthHigh", "warning", "i", "x > 20", 3)}
        union all {_runs_sql("ValueHigh", "critical", "metrics", "gauge > 10", 1)}
        union all {_runs_sql("HourlySumNotTwenty", "warning", "lag", "value <> 20", 48)}""",
    ("metrics", "lag"),
)
def alert_table(shop: Shop) -> DataFrame:
    """Three rules over different metrics, their alerts in one table: an increase, a gauge and an hourly sum."""
    samples = shop.frame("metrics")
    grown = series.increase(samples, LABELS, "ts", "counter", SIX_HOURS)
    runs = [
        ("GrowthHigh", "warning", alerts.sustained(grown, LABELS, "ts", F.col("increase") > 20, hold=10_800)),
        ("ValueHigh", "critical", alerts.sustained(samples, LABELS, "ts", F.col("gauge") > 10, hold=3_600)),
        (
            "HourlySumNotTwenty", "warning",
            alerts.sustained(shop.frame("lag"), LABELS, "ts", alerts.compare(F.col("value"), "!=", 20), hold=172_800),
        ),
    ]
    table = None
    for name, severity, found in runs:
        rows = alerts.fire(name, severity, found, LABELS)
        table = rows if table is None else table.unionByName(rows)
    labels = [F.col("labels")[c].alias(c) for c in LABELS]
    return table.select("alert", "severity", *labels, "active_at", "fired_at", "last_seen", "samples")


@query(
    "select series, instance, ts, gauge from metrics where series <> 'error' and regexp_full_match(series, 'p.*|view') "
    "and instance = 1",
    ("metrics",),
)
def metric_matchers(shop: Shop) -> DataFrame:
    samples = shop.frame("metrics").select(*LABELS, "ts", "gauge")
    return alerts.match_labels(samples, series=("=~", "p.*|view"), instance="1")


RULES = [
    RelabelRule(r"shop\.events<type=(signup|error), name=(\w+)><>Value", "shop_$1_$2"),
    RelabelRule(r"shop\.events<type=(\w+), name=(\w+), User=(\d+)><>OneMinuteRate", "Shop_Events_$2", (("User", "$3"), ("kind", "$1"))),
]


@query(
    """select event_id, case when event_type in ('signup', 'error') then 'shop_' || event_type || '_total'
              else 'shop_events_persec' end as metric,
              case when event_type in ('signup', 'error') then '' else cast(user_id as varchar) end as user_label,
              case when event_type in ('signup', 'error') then '' else event_type end as kind_label
       from events where event_type <> 'click'"""
)
def metric_relabel(shop: Shop) -> DataFrame:
    """Raw bean names made from the events, matched by two rules; clicks match none."""
    kind = F.col("event_type")
    short = F.concat(F.lit("shop.events<type="), kind, F.lit(", name=Total><>Value"))
    long = F.concat(
        F.lit("shop.events<type="), kind, F.lit(", name=PerSec, User="), F.col("user_id").cast("string"),
        F.lit("><>OneMinuteRate"),
    )
    raw = F.when(kind.isin("signup", "error"), short).when(kind == "click", F.lit("shop.clicks<>Count")).otherwise(long)
    named = alerts.relabel(shop.table("events").select("event_id", raw.alias("raw")), RULES)

    def label(name: str):
        return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))

    return named.select("event_id", "metric", label("user").alias("user_label"), label("kind").alias("kind_label"))
