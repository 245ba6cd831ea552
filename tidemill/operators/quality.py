"""The data-quality gate: rules on columns, one pass per table, a report, and a stop.

All rules of a suite are evaluated in a single aggregation; only the few result rows ever reach the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import LAYOUTS

RESULT_COLUMNS = ["suite", "rule", "column_name", "args", "total", "unexpected", "unexpected_pct", "success"]


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a row that violates the rule; ``whole`` rules judge the table instead of its rows."""

    name: str
    column: str
    args: dict = field(default_factory=dict, hash=False)
    whole: bool = False

    def broken(self, schema: T.StructType) -> Column:
        value = F.col(self.column)
        if self.name == "not_null":
            return value.isNull()
        if self.name == "between":
            low, high = self.args.get("min"), self.args.get("max")
            outside = F.lit(False)
            if low is not None:
                outside = outside | (value < F.lit(low))
            if high is not None:
                outside = outside | (value > F.lit(high))
            return F.coalesce(outside, F.lit(False))
        if self.name == "matches":
            return F.coalesce(~value.rlike(self.args["regex"]), F.lit(False))
        if self.name == "of_type":
            wanted, actual = T.DataType.fromDDL(self.args["type"]), schema[self.column].dataType
            if wanted == actual:
                return F.lit(False)
            if isinstance(actual, T.StringType):
                return value.isNotNull() & value.try_cast(wanted).isNull()
            return value.isNotNull()
        raise ValueError(f"unknown rule {self.name}")


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def between(column: str, min: object = None, max: object = None) -> Rule:  # noqa: A002
    """Values within the bounds, ends included; an open side is None, and NULL values pass."""
    return Rule("between", column, {"min": min, "max": max})


def matches(column: str, regex: str) -> Rule:
    """Values in which the pattern is found anywhere; NULL values pass."""
    return Rule("matches", column, {"regex": regex})


def of_type(column: str, type: str) -> Rule:  # noqa: A002
    """The column has the type, or is text that can be cast to it."""
    return Rule("of_type", column, {"type": type})


def row_count(min: int | None = None, max: int | None = None) -> Rule:  # noqa: A002
    return Rule("row_count", "*", {"min": min, "max": max}, whole=True)


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple[Rule, ...]

    def results(self, df: DataFrame) -> DataFrame:
        """One row per rule: rows seen, rows that break it, percentage, success. One scan of the table."""
        total = F.count(F.lit(1))
        counts = [
            self._table_miss(rule, total) if rule.whole else F.count_if(rule.broken(df.schema)) for rule in self.rules
        ]
        wide = df.agg(total.alias("total"), *[c.cast("bigint").alias(f"r{i}") for i, c in enumerate(counts)])
        rows = [
            F.struct(
                F.lit(self.name).alias("suite"),
                F.lit(rule.name).alias("rule"),
                F.lit(rule.column).alias("column_name"),
                F.lit(json.dumps(rule.args, sort_keys=True, default=str)).alias("args"),
                F.col(f"r{i}").alias("unexpected"),
            )
            for i, rule in enumerate(self.rules)
        ]
        long = wide.select("total", F.explode(F.array(*rows)).alias("r")).select("r.*", "total")
        share = F.when(F.col("total") > 0, F.col("unexpected") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
        return long.withColumns({"unexpected_pct": share, "success": F.col("unexpected") == 0}).select(*RESULT_COLUMNS)

    @staticmethod
    def _table_miss(rule: Rule, total: Column) -> Column:
        low, high = rule.args.get("min"), rule.args.get("max")
        bad = F.lit(False)
        if low is not None:
            bad = bad | (total < low)
        if high is not None:
            bad = bad | (total > high)
        return bad.cast("int")

    def marked(self, df: DataFrame) -> DataFrame:
        """Every row with the list of rules it breaks, as ``rule(column)``."""
        broken = [
            F.when(r.broken(df.schema), F.lit(f"{r.name}({r.column})")) for r in self.rules if not r.whole
        ]
        return df.withColumn("broken_rules", F.array_compact(F.array(*broken)))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that pass every row rule, quarantined rows with the rules they break)."""
        marked = self.marked(df)
        clean = F.size("broken_rules") == 0
        return marked.where(clean).drop("broken_rules"), marked.where(~clean)


BRONZE_SUITES: dict[str, Suite] = {
    "users": Suite("bronze_users", (not_null("id"), not_null("email"), matches("email", "@"))),
    "items": Suite("bronze_items", (not_null("id"), not_null("category"), between("price", min=0))),
    "purchases": Suite(
        "bronze_purchases", (not_null("id"), between("quantity", min=1), between("purchase_price", min=0))
    ),
    "pageviews": Suite("bronze_pageviews", (not_null("user_id"), not_null("url"))),
}

# The documented further checks of purchases: amount range, time type, and a table that is not empty.
PURCHASES_EXTENDED = Suite(
    "bronze_purchases_extended",
    (
        not_null("user_id"),
        not_null("item_id"),
        not_null("purchase_price"),
        between("purchase_price", min=0, max=100000),
        of_type("created_at", LAYOUTS["bronze.purchases"].schema["created_at"].dataType.simpleString()),
        row_count(min=1),
    ),
)


class GateFailed(RuntimeError):
    """Raised when any suite failed; ``failures`` holds the failing result rows."""

    def __init__(self, failures: list) -> None:
        self.failures = failures
        lines = [f"{f['suite']}: {f['rule']}({f['column_name']}) {f['args']} - {f['unexpected']} rows" for f in failures]
        super().__init__("quality gate failed\n" + "\n".join(lines))


def quality_report(tables: dict[str, DataFrame], suites: dict[str, Suite] | None = None) -> DataFrame:
    """Results of all suites over their tables."""
    report = None
    for name, suite in (suites or BRONZE_SUITES).items():
        results = suite.results(tables[name])
        report = results if report is None else report.unionByName(results)
    return report


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def gate(results: DataFrame) -> None:
    """Stop if any rule of any suite failed, naming them all. The results are a few rows, one per rule."""
    failures = results.where(~F.col("success")).collect()
    if failures:
        raise GateFailed(failures)
