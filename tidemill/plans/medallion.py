"""The daily batch flow: sources to bronze, quality gate, silver, gold, segments and features, in one application."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators import conversion, engagement, features, sales, silver
from tidemill.operators.dedup import dedup_latest, dedup_users
from tidemill.operators.maintenance import drop_old_versions
from tidemill.operators.quality import gate, quality_report
from tidemill.sinks import RunReport, export_csv, merge_rows, overwrite_partitions, replace_table
from tidemill.sources import read_layer

BRONZE = ("users", "items", "purchases", "pageviews")


@dataclass
class RunSummary:
    reports: list[RunReport] = field(default_factory=list)
    csv_path: str | None = None

    def rows(self) -> dict[str, int]:
        return {r.table: r.rows for r in self.reports}


# Whose rows change after they were first loaded, so that they may belong to another partition than before.
KEYED = ("users", "items")


def to_bronze(sources: dict[str, DataFrame], root: str) -> list[RunReport]:
    """Load the day's extracts, whole tables or what has changed.

    Users and items are merged by key, so that a changed row leaves the partition it was in. Of purchases and page views, whose day
    stays, the partitions in the extract are replaced.
    """
    return [(merge_rows if name in KEYED else overwrite_partitions)(sources[name], root, "bronze", name) for name in BRONZE]


def check_bronze(spark: SparkSession, root: str) -> None:
    """Judge the bronze tables. The report is stored whether they pass or not; a failure then stops the run."""
    replace_table(quality_report({n: read_layer(spark, root, "bronze", n) for n in BRONZE}), root, "quality", "report")
    gate(read_layer(spark, root, "quality", "report"))


def to_silver(spark: SparkSession, root: str, clean: bool = False) -> list[RunReport]:
    """Silver from bronze. ``clean`` applies the documented cleaning first: one user per e-mail address in lower case, one
    row per purchase, and purchases of unknown users or items set aside in ``quality.orphans``.
    """
    users, items, purchases, views = (read_layer(spark, root, "bronze", n) for n in BRONZE)
    reports = []
    if clean:
        purchases = dedup_latest(purchases, ["id"], ["updated_at"])
        # References go by all users there ever were, not by the one that is kept of an address.
        known = {"user_id": users, "item_id": items}
        reports.append(replace_table(silver.orphans(purchases, known), root, "quality", "orphans"))
        purchases, users = silver.drop_orphans(purchases, known), dedup_users(users)
    return reports + [
        replace_table(silver.silver_users(users), root, "silver", "users"),
        replace_table(silver.silver_items(items), root, "silver", "items"),
        overwrite_partitions(silver.enrich_purchases(purchases, users, items), root, "silver", "purchases_enriched"),
        overwrite_partitions(silver.pageviews_by_items(views, items), root, "silver", "pageviews_by_items"),
    ]


def to_gold(spark: SparkSession, root: str, now: datetime) -> list[RunReport]:
    users = read_layer(spark, root, "silver", "users")
    bought = read_layer(spark, root, "silver", "purchases_enriched")
    viewed = read_layer(spark, root, "silver", "pageviews_by_items")
    recent = read_layer(spark, root, "silver", "purchases_enriched", with_partition=True)
    tables = {
        ("gold", "top_selling_items"): sales.top_selling_items(bought),
        ("gold", "sales_performance_24h"): sales.sales_24h(recent, now),
        ("gold", "top_converting_items"): conversion.top_converting_items(viewed, bought),
        ("gold", "pageviews_by_channel"): sales.pageviews_by_channel(viewed),
        ("gold", "user_engagement_segments"): engagement.engagement(users, viewed, now),
        ("features", "user_item_interactions"): features.user_item_features(bought),
        ("features", "user_features"): features.user_features(bought),
    }
    return [replace_table(df, root, layer, name) for (layer, name), df in tables.items()]


def run_batch(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    now: datetime,
    export_to: str | None = None,
    clean: bool = False,
    keep: int | None = None,
) -> RunSummary:
    """One day's run. ``sources`` holds users, items, purchases and pageviews; a failing gate raises before silver.

    ``clean`` applies the documented cleaning. ``keep`` drops all but so many versions of each table that was written.
    """
    done = RunSummary(to_bronze(sources, root))
    check_bronze(spark, root)
    done.reports += to_silver(spark, root, clean)
    done.reports += to_gold(spark, root, now)
    if export_to:
        done.csv_path = export_csv(read_layer(spark, root, "gold", "user_engagement_segments"), export_to, now.date())
    if keep is not None:
        for report in [*done.reports, RunReport("quality.report", 0, root)]:
            layer, _, name = report.table.partition(".")
            drop_old_versions(spark, root, layer, name, keep)
    return done
