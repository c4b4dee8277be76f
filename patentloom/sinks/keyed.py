"""Keyed report tables over Parquet: insert, upsert and snapshot read.

Every write produces a complete new version folder. Spark's ``_SUCCESS`` marker is
the commit: readers take the highest marked version, so a failed or repeated write
is never visible half done. Meant for report tables, whose size is bounded by the
number of report keys and not by the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_MARK = "table_key"


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row per ``keys`` at ``path``; ``precombine`` decides between
    rows of the same key within one write. The newest
    ``keep_versions`` versions are kept for readers. One writer at a time."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    precombine: str
    keep_versions: int = 3

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        """The current snapshot."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no committed version below {self.path}")
        return self.spark.read.parquet(self._version_path(versions[-1]))

    def insert(self, rows: DataFrame) -> None:
        """Replace the table by ``rows``."""
        self._commit(self._latest_per_key(self._keyed(rows).withColumn("_incoming", F.lit(True))))

    def upsert(self, rows: DataFrame) -> None:
        """Incoming rows replace stored rows of the same key and add new keys.

        Stored and incoming rows go through one aggregation by key. Applying a batch
        again gives the same table, so a replayed micro-batch does no harm.
        """
        incoming = self._keyed(rows).withColumn("_incoming", F.lit(True))
        if not self.exists():
            self._commit(self._latest_per_key(incoming))
            return
        stored = self.read()
        self._check_keys(stored)
        self._commit(
            self._latest_per_key(
                stored.withColumn("_incoming", F.lit(False)).unionByName(incoming)
            )
        )

    def _keyed(self, rows: DataFrame) -> DataFrame:
        missing = {*self.keys, self.precombine} - set(rows.columns)
        if missing:
            raise ValueError(f"columns missing for {self.path}: {sorted(missing)}")
        return rows.na.drop(subset=list(self.keys))

    def _latest_per_key(self, rows: DataFrame) -> DataFrame:
        """Per key the greatest (incoming, precombine, other columns): the last part
        only makes ties deterministic."""
        columns = [c for c in rows.columns if c != "_incoming"]
        others = [c for c in columns if c not in self.keys and c != self.precombine]
        values = [c for c in (self.precombine, *others) if c not in self.keys]
        order: list[Column] = [F.col("_incoming"), *(F.col(c) for c in values)]
        best = rows.groupBy(*self.keys).agg(F.max(F.struct(*order)).alias("row"))
        return best.select(
            *(F.col(c) if c in self.keys else F.col(f"row.{c}").alias(c) for c in columns)
        )

    def _commit(self, rows: DataFrame) -> None:
        versions = self._versions()
        number = versions[-1] + 1 if versions else 1
        for key in self.keys:
            rows = rows.withMetadata(key, {KEY_MARK: True})
        rows.hint("rebalance").write.mode("overwrite").parquet(self._version_path(number))
        for old in versions[: max(0, len(versions) + 1 - self.keep_versions)]:
            target = self._hadoop_path(self._version_path(old))
            self._filesystem(target).delete(target, True)

    def _check_keys(self, stored: DataFrame) -> None:
        marked = {f.name for f in stored.schema.fields if KEY_MARK in (f.metadata or {})}
        if marked != set(self.keys):
            raise ValueError(f"{self.path} is keyed by {sorted(marked)}, not {list(self.keys)}")

    def _version_path(self, number: int) -> str:
        return f"{self.path}/version={number:08d}"

    def _versions(self) -> list[int]:
        pattern = self._hadoop_path(f"{self.path}/version=*/_SUCCESS")
        found = self._filesystem(pattern).globStatus(pattern) or []
        names = (status.getPath().getParent().getName() for status in found)
        return sorted(int(name.split("=")[1]) for name in names)

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _filesystem(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
