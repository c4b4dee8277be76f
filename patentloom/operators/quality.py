"""Row filters, null handling, schema contracts and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patentloom.functions.dates import date_status, is_valid_date, parsed_date
from patentloom.functions.names import is_not_blank


def with_valid_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose raw ``column`` is a valid date, with the column parsed."""
    raw = F.col(column).cast("string")
    return df.where(is_valid_date(raw)).withColumn(column, parsed_date(F.col(column)))


def date_quality(df: DataFrame, column: str) -> DataFrame:
    """Row count per date status, in one pass."""
    return df.groupBy(date_status(F.col(column)).alias("status")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def require_text(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of ``columns`` is null or blank."""
    return df.where(reduce(and_, (is_not_blank(F.col(c)) for c in columns)))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns, order and types of ``schema``."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def profile(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """Rows, nulls and distinct values per column, from one scan.

    ``distinct="exact"`` shuffles one row per (column, value) left after map-side
    aggregation; ``"approx"`` keeps a fixed-size sketch per column instead.
    """
    pairs = df.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")
                    )
                    for c in df.columns
                )
            )
        ).alias("cell")
    ).select("cell.*")
    count_values = F.count_distinct if distinct == "exact" else F.approx_count_distinct
    return pairs.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        count_values("value").alias("distinct_count"),
    )


def profile_all(tables: Mapping[str, DataFrame], distinct: str = "exact") -> DataFrame:
    """``profile`` of every table and column, with the name of the table."""
    parts = [
        profile(df, distinct).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row count collected while another action runs over it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation
