"""Parquet, CSV, JSON and text outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from patentloom.session import scratch_path


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` after a round trip through the shared folder: computed once, read as
    often as needed, and not lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    overwrite_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def new_parquet(df: DataFrame, path: str) -> None:
    """Write once; an existing path is an error."""
    df.write.mode("errorifexists").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add files. A repeated append repeats rows: use it for write-once chunks."""
    df.write.mode("append").parquet(path)


def csv_ready(df: DataFrame, separator: str = "|") -> DataFrame:
    """CSV has no arrays, so array columns become joined strings."""
    joined = {
        f.name: F.array_join(F.col(f.name).cast("array<string>"), separator)
        for f in df.schema.fields
        if isinstance(f.dataType, ArrayType)
    }
    return df.withColumns(joined)


def write_csv(
    df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite"
) -> None:
    """CSV directory with headers, balanced over ``files`` files where given."""
    out = df if files is None else df.repartition(files)
    csv_ready(out).write.mode(mode).option("header", True).csv(path)


def write_single_csv(report: DataFrame, path: str) -> None:
    """One CSV file, for small report tables only: one task writes all rows.

    The repartition keeps the report's own computation parallel, which a plain
    ``coalesce(1)`` would pull into that one task.
    """
    write_csv(report, path, files=1)


def write_text_parts(ordered: DataFrame, path: str, column: str = "value") -> None:
    """One text file per partition, in partition order."""
    ordered.select(column).write.mode("overwrite").text(path)


def write_monthly_json(records: DataFrame, path: str, date_column: str) -> None:
    """JSON lines below one ``month=YYYY_Mon`` folder per month.

    Records are dealt by month first, large months over several tasks, so that the number
    of files follows the data and not tasks times months.
    """
    month = F.date_format(F.col(date_column).cast("date"), "yyyy_MMM")
    dealt = records.withColumn("month", month).hint("rebalance", "month")
    dealt.write.mode("overwrite").partitionBy("month").json(path)


def save_all(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Write every table below ``path``; failures are raised together at the end, so
    one bad table does not hide the state of the others."""
    errors = {}
    for name, df in tables.items():
        try:
            writer = (csv_ready(df) if fmt == "csv" else df).write.mode("overwrite").format(fmt)
            if fmt == "csv":
                writer = writer.option("header", True)
            writer.save(f"{path}/{name}")
        except Exception as error:
            errors[name] = error
    if errors:
        detail = "; ".join(f"{name}: {error}" for name, error in errors.items())
        raise RuntimeError(f"tables not saved: {detail}")
    return [f"{path}/{name}" for name in tables]


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Table pre-shuffled by ``key``: joins and groupings on it read without a shuffle
    as long as both sides use the same number of buckets.

    The repartition makes each task write one bucket instead of a file per bucket.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
