"""Text scans that keep the order of lines and the shape of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that, taken together, order lines as they stand in the input.
LINE_ORDER = ["file", "block", "line"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its place: file, byte offset of the split, order inside it.

    A task reads each split front to back, so the increasing id orders the lines of
    one split; file and offset order the splits.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


#: Record ids: letters and digits, so that quoted words in a text are none.
RECORD_ID = "[0-9A-Za-z]*"


def opening_rule(id_pattern: str = RECORD_ID) -> str:
    """Lines that open a record: the quoted id, then a tab. Groups: id and rest."""
    return rf'^"({id_pattern})"\t(.*)$'


def rejected_openings(
    lines: DataFrame, id_column: str = "patent_id", id_pattern: str = RECORD_ID
) -> DataFrame:
    """Per file the number of lines that start with a quote and yet open no record.

    They are kept as text of the record they stand in; the count shows files whose ids do
    not have the expected form.
    """
    quoted = F.col("value").startswith('"') & ~F.col("value").rlike(header_rule(id_column))
    wrong = quoted & ~F.col("value").rlike(opening_rule(id_pattern))
    return lines.groupBy("file").agg(F.count_if(wrong).alias("rejected"))


def header_rule(id_column: str) -> str:
    return rf'^"?{id_column}"?\t'


def read_quoted_records(
    spark: SparkSession,
    path: str,
    id_column: str = "patent_id",
    text_column: str = "summary_text",
    id_pattern: str = RECORD_ID,
) -> DataFrame:
    """Records that open with ``"id"`` and a tab at a line start and run over many lines.

    Other lines that start with a quote, doubled or not, belong to the record they stand in.
    A header line, quoted or not, text before the first record and records of blank ids are
    dropped. Records may run over the end of a split.
    """
    from patentloom.operators.stitch import stitch_lines

    return stitch_lines(read_lines(spark, path), True, id_column, text_column, id_pattern)
