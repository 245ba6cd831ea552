"""Text functions of the cleaning step and of search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill import fixed


def valid_email(email: Column) -> Column:
    """Whether the whole value is an e-mail address; NULL stays NULL."""
    return email.rlike(fixed.EMAIL_PATTERN)


def full_name(first: Column, last: Column) -> Column:
    """First and last name; a missing part is left out."""
    return F.concat_ws(" ", first, last)


def full_name_strict(first: Column, last: Column) -> Column:
    """First and last name; NULL if either part is missing."""
    return F.concat(first, F.lit(" "), last)


def norm_category(category: Column) -> Column:
    return F.upper(category)


def clean_text(text: Column) -> Column:
    return F.trim(text)


def norm_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def url_page(url: Column) -> Column:
    """The first path step of ``/page/123``; the empty string for any other shape."""
    return F.regexp_extract(url, fixed.URL_PAGE_PATTERN, 1)


def url_item_id(url: Column) -> Column:
    """The number a URL ends in; NULL if it ends in none, or in one that is no bigint."""
    return F.regexp_extract(url, fixed.URL_ITEM_PATTERN, 1).try_cast("bigint")


def utm(url: Column, key: str) -> Column:
    """One ``utm_*`` parameter of a URL; NULL if absent or if the URL does not parse."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(f"utm_{key}"))


def tokens(text: Column) -> Column:
    """Lower-cased words of a text, in order; NULL text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), fixed.WORD_BREAK_PATTERN), "")
