"""Top-k reports. The ordering always ends in keys that make it total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps ``k``, one task merges them."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group with their rank from 1.

    Spark turns the rank filter into a group limit on both sides of the shuffle, so
    a task sends at most ``k`` rows per group however large a group is.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
