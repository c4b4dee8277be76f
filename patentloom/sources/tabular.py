"""Delimited and columnar scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Tab-separated bulk file with a header line and a declared schema."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV whose types come from the data. Inference is a second pass over the
    input, so prefer ``read_csv``; a lower ``sampling_ratio`` makes it cheaper."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
    )


def read_csv_strings(spark: SparkSession, path: str, casts: Mapping[str, str] = {}) -> DataFrame:
    """CSV read as text with some columns cast; text that does not fit is null."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in casts.items()})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
