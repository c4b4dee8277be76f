"""Result shapes both engines can produce alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that the order of summation does not show."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def joined(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as strings."""
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
