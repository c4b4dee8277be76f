"""Joins by shared key columns; the key appears once in the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, list(keys), "inner")


def left_outer(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, list(keys), "left")


def full_outer(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Full outer join; each key column is the coalesced key of both sides."""
    return left.join(right, list(keys), "full")


def matching(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``left`` with a partner, however many partners there are."""
    return left.join(right, list(keys), "left_semi")


def without_match(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, list(keys), "left_anti")


def frequency_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    frequency: str,
    columns: Sequence[str],
    hot_keys: int = 1_000,
) -> DataFrame:
    """Inner join of ``facts`` with one lookup row per key, for keys of uneven weight.

    ``frequency`` is the number of facts per key. The ``hot_keys`` most frequent keys
    are broadcast, a size fixed by the limit, and their facts stay where they are. The
    facts of every other key are shuffled: such a key holds at most one part in
    ``hot_keys`` of all facts, so no task is left with a large share.
    """
    hot = lookup.orderBy(F.desc(frequency), F.asc(key)).limit(hot_keys)
    tagged = facts.join(
        F.broadcast(hot.select(key, *(F.col(c).alias(f"hot_{c}") for c in columns))), key, "left"
    )
    is_hot = F.col(f"hot_{columns[0]}").isNotNull()
    on_hot = tagged.where(is_hot).select(
        *facts.columns, *(F.col(f"hot_{c}").alias(c) for c in columns)
    )
    on_cold = (
        tagged.where(~is_hot)
        .select(*facts.columns)
        .join(lookup.select(key, *columns), key)
        .select(*facts.columns, *columns)
    )
    return on_hot.unionByName(on_cold)
