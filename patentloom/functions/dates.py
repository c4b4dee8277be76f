"""Date parsing, quality classes and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: dates accepted as valid, applied to the ISO form of a parsed date.
VALID_DATE = r"^(19|20)\d{2}-[0-1]\d-[0-3]\d$"


def parsed_date(raw: Column) -> Column:
    """The date held by a raw string, null where it is not a calendar date."""
    return raw.try_cast("date")


def is_valid_date(raw: Column) -> Column:
    """True for calendar dates of the 20th and 21st century, never null."""
    return F.coalesce(parsed_date(raw).cast("string").rlike(VALID_DATE), F.lit(False))


def date_status(raw: Column) -> Column:
    """``missing``, ``malformed``, ``out_of_range`` or ``valid``."""
    return (
        F.when(raw.isNull() | (F.trim(raw) == ""), "missing")
        .when(parsed_date(raw).isNull(), "malformed")
        .when(is_valid_date(raw), "valid")
        .otherwise("out_of_range")
    )


def bucket_start(date: Column, grain: str) -> Column:
    """First day of the ``year``, ``month`` or ``day`` holding ``date``."""
    if grain == "day":
        return date.cast("date")
    return F.trunc(date, grain)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def grant_days(granted: Column, filed: Column) -> Column:
    return F.datediff(granted, filed)
