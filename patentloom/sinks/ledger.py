"""Append-only tables of micro-batches: one folder per batch, written once or again.

A replayed batch overwrites its own folder, so every batch counts exactly once. What is
kept is what can be added up later: rows, partial counts, sketches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ledger:
    """Batches at ``path`` with the columns of ``schema`` and ``batch_id``."""

    spark: SparkSession
    path: str
    schema: str

    def write(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, before: int | None = None) -> DataFrame:
        """All batches, or those before one: what a replayed batch saw the first time."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        schema = f"{self.schema}, batch_id long"
        if not path.getFileSystem(conf).exists(path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if before is None else rows.where(F.col("batch_id") < before)
