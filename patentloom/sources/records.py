"""Nested API records as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patentloom import schemas


def read_api_records(
    spark: SparkSession, path: str, schema: str = schemas.API_RECORDS, multi_line: bool = False
) -> DataFrame:
    """Line-delimited records; ``multi_line`` for files holding one indented array.

    A multi-line file is one task whatever its size, so keep such files small.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
