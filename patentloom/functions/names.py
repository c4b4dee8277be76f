"""Names of people, organisations and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_organization(raw: Column) -> Column:
    """Fold case differences between spellings of one organisation."""
    return F.initcap(F.lower(raw))


def full_name(first: Column, last: Column) -> Column:
    """``first last``; null when either part is missing."""
    return F.concat(first, F.lit(" "), last)


def prefixed(value: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), value) if prefix else value


def is_not_blank(value: Column) -> Column:
    return value.isNotNull() & (F.trim(value) != "")
