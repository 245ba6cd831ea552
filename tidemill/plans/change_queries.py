"""Change-log queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import changes as cdc
from tidemill.operators import sales
from tidemill.plans.catalog import Shop, query
from tidemill.schemas import declared
from tidemill.sources import unwrap
from tidemill.sources.events import ISO_MICROS

IMAGE = declared("id bigint, inventory int, price money(7)")

_ROW = "seq, ts, id, op, inventory, cast(price as double) as price"
_LATEST = f"""select {_ROW} from (select *, row_number() over (partition by id order by seq desc) as rn from changes {{where}})
    where rn = 1 and op <> 'd'"""


def _typed(changes: DataFrame) -> DataFrame:
    return changes.withColumn("price", F.col("price").cast("decimal(7,2)"))


def _envelopes(changes: DataFrame) -> DataFrame:
    """The change log as a connector writes it: one JSON envelope per change, decimals as text."""
    image = F.struct("id", "inventory", "price")
    deleted = F.col("op") == "d"
    envelope = F.struct(
        "op",
        "seq",
        "ts",
        F.when(deleted, image).alias("before"),
        F.when(~deleted, image).alias("after"),
    )
    return changes.select(F.to_json(envelope, {"timestampNTZFormat": ISO_MICROS}).alias("value"))


@query(f"select {_ROW} from changes", ("changes",))
def cdc_unwrap(shop: Shop) -> DataFrame:
    return unwrap(_envelopes(shop.frame("changes")), IMAGE, "id")


@query(_LATEST.format(where=""), ("changes",))
def cdc_latest_state(shop: Shop) -> DataFrame:
    return cdc.latest_state(_typed(shop.frame("changes")), "id")


@query(_LATEST.format(where="where ts <= timestamp '2024-01-15 12:00:00'"), ("changes",))
def cdc_as_of(shop: Shop) -> DataFrame:
    return cdc.as_of(_typed(shop.frame("changes")), "id", datetime(2024, 1, 15, 12))


@query(_LATEST.format(where=""), ("changes",))
def cdc_apply(shop: Shop) -> DataFrame:
    """The state of the first half of the month, with the second half's changes applied to it as one batch."""
    changes = _typed(shop.frame("changes"))
    middle = F.expr("timestamp_ntz'2024-01-15 12:00:00'")
    state = cdc.newest_change(changes.where(F.col("ts") <= middle), "id")
    return cdc.live(cdc.apply_changes(state, changes.where(F.col("ts") > middle), "id"))


@query(
    """select seq, id, concat_ws(',', case when inventory_before is distinct from inventory_after then 'inventory' end,
              case when price_before is distinct from price_after then 'price' end) as changed from images""",
    ("images",),
)
def cdc_changed_columns(shop: Shop) -> DataFrame:
    images = shop.frame("images").select(
        "seq",
        "id",
        F.struct(F.col("inventory_before").alias("inventory"), F.col("price_before").alias("price")).alias("before"),
        F.struct(F.col("inventory_after").alias("inventory"), F.col("price_after").alias("price")).alias("after"),
    )
    changed = cdc.changed_columns(images, ["inventory", "price"])
    return changed.select("seq", "id", F.array_join("changed", ",").alias("changed"))


@query(
    """with h as (select * from purchases union all
                  select id, user_id, item_id, campaign_id, status, quantity + 1, purchase_price, deleted, created_at,
                         updated_at + interval 1 hour from purchases where campaign_id is not null),
            l as (select *, row_number() over (partition by id order by updated_at desc) as rn from h)
       select item_id, cast(sum(quantity) as bigint) as total_quantity,
              cast(sum(quantity * purchase_price) as double) as total_revenue
       from l where rn = 1 and not deleted group by all order by sum(quantity * purchase_price) desc, item_id limit 10""",
    ("purchases",),
)
def flash_top_items_latest(shop: Shop) -> DataFrame:
    """Top items over the latest version of each purchase, deleted ones left out, where campaign sales changed once."""
    first = shop.frame("purchases")
    second = first.where(F.col("campaign_id").isNotNull()).withColumns(
        {"quantity": F.col("quantity") + 1, "updated_at": F.col("updated_at") + F.expr("interval 1 hour")}
    )
    history = first.unionByName(second).withColumn("op", F.when(F.col("deleted"), "d").otherwise("u"))
    return sales.flash_top_items(cdc.latest_state(history, "id", "updated_at"))
