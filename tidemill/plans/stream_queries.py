"""Stream queries: each runs a stream over the event table to its end and returns what its sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import sales
from tidemill.plans.catalog import Shop, query
from tidemill.plans.learn_queries import SEARCH, bm25_sql
from tidemill.plans.frames import NOW, SENTINEL, derive, source
from tidemill.schemas import PURCHASE_EVENT
from tidemill.session import run_dir, stream_session
from tidemill.sinks import replace_table
from tidemill.sources.events import ISO_MICROS, read_event_stream
from tidemill.sources.tables import read_dimension
from tidemill.streaming import changes as keyed
from tidemill.streaming import intake, logins, lookup, purchases, runner
from tidemill.streaming import search as live_search

_ALERTS = """
    select l.user_id, u.email as user_email, date_trunc('day', ts) as window_start,
           date_trunc('day', ts) + interval 1 day as window_end, count(*) as login_count,
           count(distinct device) as distinct_devices, 'SUSPICIOUS_MULTI_DEVICE' as alert_type
    from (select *, strptime(login_ts, '%Y-%m-%d %H:%M:%S.%g') as ts from logins) l
    left join silver_users u on l.user_id = u.id
    group by l.user_id, u.email, date_trunc('day', ts) having count(*) > 5 and count(distinct device) > 2"""
_ENRICHED = """
    select l.user_id, u.email as user_email, u.first_name || ' ' || u.last_name as full_name, login_ts, ip_address, device,
           is_success
    from logins l left join silver_users u on l.user_id = u.id"""


def _event_stream(spark: SparkSession, sf_dir: str, closing: bool = False) -> DataFrame:
    """The event table as a stream; ``closing`` adds one far later event, so that the last windows end."""
    schema = source(spark, sf_dir, "events").schema
    # A pattern: the file source takes folders and patterns, not the path of a single file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    if not closing:
        return events
    late = spark.createDataFrame(
        [(-1, SENTINEL, -1, "purchase", 0.0, '{"k": 0}')],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    )
    folder = run_dir(spark, "closing")
    late.write.parquet(folder)
    return events.unionByName(spark.readStream.schema(schema).parquet(folder))


class _Run:
    """Folders of one stream run, and a session whose time zone is UTC."""

    def __init__(self, shop: Shop, name: str) -> None:
        self.spark = stream_session(shop.spark)
        root = run_dir(shop.spark, name)
        self.out, self.checkpoint = f"{root}/out", f"{root}/checkpoint"


@query(_ENRICHED, ("logins", "silver_users"))
def login_enriched(shop: Shop) -> DataFrame:
    return logins.enrich_logins(shop.frame("logins"), shop.users())


@query(_ENRICHED, ("logins", "silver_users"))
def login_enriched_stream(shop: Shop) -> DataFrame:
    run = _Run(shop, "enriched")
    events = derive(run.spark, "logins", {"events": _event_stream(run.spark, shop.sf_dir)})
    inner = Shop(run.spark, shop.sf_dir)
    runner.run_append(logins.enrich_logins(events, inner.users()), run.out, run.checkpoint)
    return shop.spark.read.parquet(run.out)


@query(_ALERTS, ("logins", "silver_users"))
def login_alerts(shop: Shop) -> DataFrame:
    return logins.login_alerts(shop.frame("logins"), shop.users(), window="1 day")


@query(_ALERTS, ("logins", "silver_users"))
def login_alerts_stream(shop: Shop) -> DataFrame:
    run = _Run(shop, "alerts")
    events = derive(run.spark, "logins", {"events": _event_stream(run.spark, shop.sf_dir, closing=True)})
    inner = Shop(run.spark, shop.sf_dir)
    alerts = logins.login_alerts(events, inner.users(), window="1 day")
    runner.run_append(alerts, run.out, run.checkpoint)
    return shop.spark.read.parquet(run.out)


@query(
    "select date_trunc('hour', created_at) as hour, cast(sum(quantity) as bigint) as total_sales from purchases "
    "where not deleted group by all",
    ("purchases",),
)
def stream_hourly_volume(shop: Shop) -> DataFrame:
    run = _Run(shop, "hourly")
    bought = derive(run.spark, "purchases", {"events": _event_stream(run.spark, shop.sf_dir, closing=True)})
    runner.run_append(purchases.stream_hourly_volume(bought), run.out, run.checkpoint)
    return shop.spark.read.parquet(run.out)


@query("select event_id, user_id, login_ts, device from logins", ("logins",))
def stream_dedup(shop: Shop) -> DataFrame:
    """Every login delivered twice, taken once."""
    run = _Run(shop, "dedup")
    once = derive(run.spark, "logins", {"events": _event_stream(run.spark, shop.sf_dir)})
    again = derive(run.spark, "logins", {"events": _event_stream(run.spark, shop.sf_dir)})
    twice = once.unionByName(again).withColumn("event_time", F.to_timestamp("login_ts"))
    kept = runner.stream_dedup(twice, ["event_id"]).select("event_id", "user_id", "login_ts", "device")
    runner.run_append(kept, run.out, run.checkpoint)
    return shop.spark.read.parquet(run.out)


_LATEST = """select seq, ts, id, op, inventory, price from (
    select *, row_number() over (partition by id order by seq desc) as rn from changes) where rn = 1 and op <> 'd'"""


@query(_LATEST, ("changes",))
def cdc_apply_stream(shop: Shop) -> DataFrame:
    """The change log streamed into a keyed table, folded into a base, and read back."""
    run = _Run(shop, "keyed")
    changes = derive(run.spark, "changes", {"events": _event_stream(run.spark, shop.sf_dir)})
    keyed.apply_stream(changes, run.out, run.checkpoint, "id")
    keyed.fold(shop.spark, run.out, "id")
    return keyed.read_state(shop.spark, run.out, "id")


@query(
    """select item_id, cast(sum(quantity) as bigint) as total_quantity,
              cast(sum(quantity * purchase_price) as double) as total_revenue
       from purchases group by all order by sum(quantity * purchase_price) desc, item_id limit 10""",
    ("purchases",),
)
def stream_ingest_top_items(shop: Shop) -> DataFrame:
    """Purchases ingested by a stream into the append-only table, then the dashboard's top items over it."""
    run = _Run(shop, "ingest")
    bought = derive(run.spark, "purchases", {"events": _event_stream(run.spark, shop.sf_dir)})
    purchases.ingest_append(bought, run.out, run.checkpoint)
    return sales.flash_top_items(purchases.read_ingested(shop.spark, run.out))


@query(
    f"""select date_trunc('hour', created_at) as hour, cast(sum(quantity) as bigint) as total_sales from purchases
        where not deleted and created_at >= timestamp '{NOW:%Y-%m-%d %H:%M:%S}' - interval 24 hour group by all""",
    ("purchases",),
)
def stream_ingest_hourly(shop: Shop) -> DataFrame:
    run = _Run(shop, "ingest")
    bought = derive(run.spark, "purchases", {"events": _event_stream(run.spark, shop.sf_dir)})
    purchases.ingest_append(bought, run.out, run.checkpoint)
    return sales.hourly_volume(purchases.read_ingested(shop.spark, run.out), NOW)


MIDDLE = "2024-01-15 12:00:00"


def _halves(run: _Run, sf_dir: str, name: str) -> list[DataFrame]:
    """A frame's stream of the month's first half, and of the rest."""
    events = _event_stream(run.spark, sf_dir)
    early = F.col("ts") <= F.lit(MIDDLE).cast("timestamp_ntz")
    return [derive(run.spark, name, {"events": events.where(c)}) for c in (early, ~early)]


@query(
    "select id, user_id, item_id, quantity, cast(purchase_price as double) as purchase_price, deleted, created_at from purchases",
    ("purchases",),
)
def stream_ingest_restart(shop: Shop) -> DataFrame:
    """Two streams with checkpoints of their own, the second after a compaction; then the first one's batches once more."""
    run = _Run(shop, "restart")
    early, late = _halves(run, shop.sf_dir, "purchases")
    purchases.ingest_append(early, run.out, f"{run.checkpoint}/a")
    purchases.compact_ingested(shop.spark, run.out)
    purchases.ingest_append(late, run.out, f"{run.checkpoint}/b")
    purchases.compact_ingested(shop.spark, run.out)
    purchases.ingest_append(early, run.out, f"{run.checkpoint}/lost")
    table = purchases.read_ingested(shop.spark, run.out)
    return table.select("id", "user_id", "item_id", "quantity", "purchase_price", "deleted", "created_at")


@query(_LATEST, ("changes",))
def cdc_apply_restart(shop: Shop) -> DataFrame:
    """The later half of the change log first, folded; then the earlier half under a new checkpoint."""
    run = _Run(shop, "restart")
    early, late = _halves(run, shop.sf_dir, "changes")
    keyed.apply_stream(late, run.out, f"{run.checkpoint}/a", "id")
    keyed.fold(shop.spark, run.out, "id")
    keyed.apply_stream(early, run.out, f"{run.checkpoint}/b", "id")
    return keyed.read_state(shop.spark, run.out, "id")


_EDITED = "concat(substr(text, 1, 200), ' of the wonder sounds')"
# What happens to the documents, in the order in which it is delivered: (op, sequence, text, which).
_EDITS = [
    ("c", "doc_id", "text", "true"),
    ("u", "1000000000 + doc_id", _EDITED, "doc_id % 7 = 0"),
    ("d", "2000000000 + doc_id", "cast(null as string)", "doc_id % 11 = 0"),
    ("u", "-1 - doc_id", "'the wonder of things, late'", "doc_id % 13 = 0"),
]


@query(bm25_sql(f"(select doc_id, case when doc_id % 7 = 0 then {_EDITED} else text end as text from documents where doc_id % 11 <> 0)"))
def keyword_search_changes(shop: Shop) -> DataFrame:
    """Search over an index that took inserts, updates, deletes and changes that came too late, and merged its segments."""
    run = _Run(shop, "index")
    schema = shop.table("documents").schema
    for i, (op, seq, text, which) in enumerate(_EDITS):
        docs = run.spark.readStream.schema(schema).parquet(f"{shop.sf_dir}/documents*.parquet").where(which)
        changes = docs.select("doc_id", F.lit(op).alias("op"), F.expr(seq).alias("seq"), F.expr(text).alias("text"))
        live_search.index_stream(changes, run.out, f"{run.checkpoint}/{i}", "doc_id", "text")
        if i == 1:
            live_search.merge_segments(shop.spark, run.out, everything=True)
    found = live_search.search(shop.spark, run.out, SEARCH, key="doc_id")
    return found.withColumn("score", F.round("score", 6))


_PROFILE = ["id", "first_name", "last_name", "email"]
# Profiles as the later logins and alerts see them: some users are gone, some have moved.
_MOVED = "(select * replace (case when id % 4 = 0 then 'moved-' || email else email end as email) from silver_users where id % 9 <> 0)"


class _Profiles:
    """The users' table of a shop, which changes while a stream runs over logins that arrive in two files."""

    def __init__(self, shop: Shop, run: _Run) -> None:
        self.shop, self.root, self.folder, self.spark = shop, run_dir(shop.spark, "profiles"), f"{run_dir(shop.spark, 'logins')}", run.spark
        self.put(shop.users())

    def put(self, users: DataFrame) -> None:
        replace_table(users, self.root, "silver", "users")

    def move(self) -> None:
        moved = F.when(F.col("id") % 4 == 0, F.concat(F.lit("moved-"), "email")).otherwise(F.col("email"))
        self.put(self.shop.users().where("id % 9 <> 0").withColumn("email", moved))

    def now(self) -> DataFrame:
        return read_dimension(self.spark, self.root, "silver", "users", _PROFILE)

    def arrive(self, which: str) -> None:
        self.shop.frame("logins").where(which).write.mode("append").parquet(self.folder)

    def stream(self) -> DataFrame:
        schema = self.shop.frame("logins").schema
        return self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(self.folder)


@query(
    f"""select l.user_id, u.email as user_email, u.first_name || ' ' || u.last_name as full_name, login_ts, ip_address, device, is_success
        from logins l left join silver_users u on l.user_id = u.id where login_ts <= '{MIDDLE}'
        union all
        select l.user_id, u.email, u.first_name || ' ' || u.last_name, login_ts, ip_address, device, is_success
        from logins l left join {_MOVED} u on l.user_id = u.id where login_ts > '{MIDDLE}'""",
    ("logins", "silver_users"),
)
def login_enriched_live(shop: Shop) -> DataFrame:
    """Two batches of logins, between which profiles change and vanish."""
    run = _Run(shop, "live")
    users = _Profiles(shop, run)
    for late, which in enumerate((f"login_ts <= '{MIDDLE}'", f"login_ts > '{MIDDLE}'")):
        if late:
            users.move()
        users.arrive(which)
        logins.enrich_logins_live(users.stream(), users.now, run.out, run.checkpoint)
    return lookup.read_enriched(shop.spark, run.out)


@query(
    _ALERTS.replace("left join silver_users u", f"left join {_MOVED} u"),
    ("logins", "silver_users"),
)
def login_alerts_live(shop: Shop) -> DataFrame:
    """Alerts whose windows are still open when profiles change: they carry the profile of the moment they are raised."""
    run = _Run(shop, "live")
    users = _Profiles(shop, run)
    end = f"{SENTINEL:%Y-%m-%d %H:%M:%S}.000"
    users.arrive("login_ts < '2024-01-01 12:00:00'")  # no window is over yet
    logins.login_alerts_live(users.stream(), users.now, run.out, run.checkpoint, window="1 day")
    users.move()
    users.arrive("login_ts >= '2024-01-01 12:00:00'")
    late = shop.frame("logins").limit(1).withColumns({"login_ts": F.lit(end), "user_id": F.lit(-1)})
    late.write.mode("append").parquet(users.folder)
    logins.login_alerts_live(users.stream(), users.now, run.out, run.checkpoint, window="1 day")
    return lookup.read_enriched(shop.spark, run.out)


# A row of the first half with an id like this is delivered with the second half.
_HELD_BACK = "id % 10 = 3"
_TAKEN = """select 'rows' as kind, cast({id} as bigint) as id, user_id, item_id, coalesce(campaign_id, '') as campaign_id, cast(1 as smallint) as status,
    quantity, cast(purchase_price as double) as purchase_price, case when id % 4 = 0 then false else deleted end as deleted, created_at"""


@query(
    f"""with e as (select *, created_at <= timestamp '{MIDDLE}' as early, id % 50 = 7 as broken from purchases),
             first_half as (select max(created_at) - interval 1 day as bound from e where early and not ({_HELD_BACK}) and not broken),
             t as (select * from e, first_half where not broken),
             m as (select *, early and {_HELD_BACK} and created_at < bound as late from t)
        {_TAKEN.format(id="case when id % 2 = 0 then 0 else id end").replace("'rows' as kind", "case when late then 'late' else 'rows' end as kind")}
        from m
        union all
        select 'bad', null, null, null, null, null, null, null, null, null from e where broken""",
    ("purchases",),
)
def stream_source_defaults(shop: Shop) -> DataFrame:
    """JSON events as a producer writes them: fields left out get their defaults, bad lines and late rows are set aside."""
    run = _Run(shop, "intake")
    bought, folder = shop.frame("purchases"), f"{run_dir(shop.spark, 'topic')}"
    # Half of the events have no id, a quarter no mark of deletion, and none a status or a time of change.
    told = F.to_json(
        F.struct(
            F.when(F.col("id") % 2 != 0, F.col("id")).alias("id"), "user_id", "item_id", "campaign_id", "quantity",
            F.col("purchase_price").cast("string").alias("purchase_price"), F.when(F.col("id") % 4 != 0, F.col("deleted")).alias("deleted"), "created_at",
        ),
        {"timestampNTZFormat": ISO_MICROS},
    )
    line = F.when(F.col("id") % 50 == 7, F.concat(F.lit('{"user_id": "no number", '), F.expr("substr(value, 2)"))).otherwise(F.col("value"))
    lines = bought.withColumn("value", told).withColumn("value", line)
    early = (F.col("created_at") <= F.lit(MIDDLE).cast("timestamp_ntz")) & ~F.expr(_HELD_BACK)
    for which in (early, ~early):
        lines.where(which).select("value").write.mode("append").text(folder)
        stream = read_event_stream(run.spark, folder, PURCHASE_EVENT, defaults={"id": 0, "campaign_id": "", "status": 1, "deleted": False}, corrupt=True)
        intake.take_in(stream, run.out, run.checkpoint, "created_at", "1 day")
    columns = ("id", "user_id", "item_id", "campaign_id", "status", "quantity", "purchase_price", "deleted", "created_at")
    kinds = [intake.read_taken(shop.spark, run.out, kind).withColumn("kind", F.lit(kind)) for kind in ("rows", "late", "bad")]
    kinds[2] = kinds[2].select("kind", *[F.lit(None).cast(kinds[0].schema[c].dataType).alias(c) for c in columns])
    return kinds[0].select("kind", *columns).unionByName(kinds[1].select("kind", *columns)).unionByName(kinds[2])
