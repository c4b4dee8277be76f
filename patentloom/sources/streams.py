"""File streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom import schemas

CORRUPT = "_corrupt_record"


def json_stream(
    spark: SparkSession,
    path: str,
    schema: str = schemas.PATENT_STREAM,
    multi_line: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """JSON files as they arrive, with unparsable input kept in ``_corrupt_record``."""
    reader = (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parsed_only(records: DataFrame) -> DataFrame:
    """Rows that parsed; how many did not is reported as metric ``malformed``."""
    return (
        records.observe(
            "parsing",
            F.count(F.lit(1)).alias("rows"),
            F.count(CORRUPT).alias("malformed"),
        )
        .where(F.col(CORRUPT).isNull())
        .drop(CORRUPT)
    )
