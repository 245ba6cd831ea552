"""De-duplication. Both forms reduce rows inside each map task before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import clean_text, norm_email


def newest_first(df: DataFrame, order: list[str]) -> list[Column]:
    """A total order: the given columns first, then every other sortable column, so that a tie has one winner."""
    rest = [f.name for f in df.schema.fields if f.name not in order and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(c).desc_nulls_last() for c in [*order, *rest]]


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits each group inside the map tasks before it shuffles (WindowGroupLimit), so a key that holds a large part
    of all rows reaches its reducer as at most ``n`` rows per map task.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n).drop(rank)


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns."""
    return top_per_key(df, keys, newest_first(df, order))


def dedup_users(users: DataFrame) -> DataFrame:
    """One user per e-mail address, compared in lower case without outer space: the one updated last."""
    return dedup_latest(users.withColumn("email", norm_email(F.col("email"))), ["email"], ["updated_at"])


def dedup_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """One row per trimmed text: the one with the smallest key.

    Texts are compared by their SHA-256 digest, so the grouping key is short however long the text is.
    """
    digest = "__digest"
    cleaned = df.withColumn(text, clean_text(F.col(text)))
    ranked = cleaned.withColumn(digest, F.sha2(F.col(text), 256))
    return top_per_key(ranked, [digest], [F.col(key).asc_nulls_last()]).drop(digest)
