"""Keyed tables whose upserts read and write only the parts that a batch touches.

An upsert makes a new version folder with one subfolder per part it changes; a part is current in
the newest committed version that holds it. The marker that Spark leaves behind a finished job
is the commit, as in ``keyed``: a batch is visible whole or not at all, a replayed one changes
nothing, and the files of all other parts stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.sinks.keyed import KEY_MARK, KeyedTable

PART = "part"
#: Versions that replace the table, and those that replace some of its parts.
FULL, SOME = "full", "some"


@dataclass(frozen=True)
class ScopedTable(KeyedTable):
    """A keyed table in parts. ``part`` is a string that the keys determine, such as a month or
    a hash of the key modulo a number; keys with a null part are in none. The parts of one
    batch and the list of current folders go through the driver: months, not keys."""

    part: Column = field(kw_only=True)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The current snapshot, or these parts of it."""
        current = self.current_parts()
        if not current:
            raise FileNotFoundError(f"no committed version below {self.path}")
        folders = [f for p, f in current.items() if parts is None or p in parts]
        # Without its folders an empty selection still has the table's columns.
        df = self.spark.read.parquet(*(folders or [*current.values()][:1]))
        return df if folders else df.limit(0)

    def current_parts(self) -> dict[str, str]:
        """Parts and the folder of each: in the newest version, and no older than the last
        that replaced the table."""
        committed = self._committed()
        oldest = max((n for n, kind in committed.items() if kind == FULL), default=0)
        pattern = self._hadoop_path(f"{self.path}/*=*/{PART}=*")
        newest: dict[str, tuple[int, str]] = {}
        for status in self._filesystem(pattern).globStatus(pattern) or []:
            folder = status.getPath()
            kind, number = folder.getParent().getName().split("=")
            if committed.get(int(number)) == kind and int(number) >= oldest:
                name = folder.getName().split("=", 1)[1]
                newest[name] = max((int(number), str(folder)), newest.get(name, (0, "")))
        return {name: folder for name, (_, folder) in sorted(newest.items())}

    def exists(self) -> bool:
        return bool(self._committed())

    def insert(self, rows: DataFrame) -> None:
        """Replace the table by ``rows``."""
        incoming = self._keyed(rows).withColumn("_incoming", F.lit(True))
        self._write(self._latest_per_key(incoming), FULL)

    def upsert(self, rows: DataFrame) -> None:
        """As in ``KeyedTable``; only the parts that ``rows`` has keys of are read and written."""
        incoming = self._keyed(rows).withColumn("_incoming", F.lit(True))
        if not self.exists():
            self._write(self._latest_per_key(incoming), SOME)
            return
        touched = [r[0] for r in incoming.select(self.part).distinct().collect()]
        stored = self.read(touched)
        self._check_keys(stored)
        both = stored.withColumn("_incoming", F.lit(False)).unionByName(incoming)
        self._write(self._latest_per_key(both), SOME)

    def _committed(self) -> dict[int, str]:
        pattern = self._hadoop_path(f"{self.path}/*=*/_SUCCESS")
        found = self._filesystem(pattern).globStatus(pattern) or []
        names = (status.getPath().getParent().getName().split("=") for status in found)
        return {int(number): kind for kind, number in names}

    def _write(self, rows: DataFrame, kind: str) -> None:
        for key in self.keys:
            rows = rows.withMetadata(key, {KEY_MARK: True})
        committed = self._committed()
        number = max(committed, default=0) + 1
        named = rows.withColumn(PART, F.regexp_replace(self.part, "[^A-Za-z0-9-]", "_"))
        target = f"{self.path}/{kind}={number:08d}"
        named.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(target)
        live = {int(f.rsplit("/", 2)[1].split("=")[1]) for f in self.current_parts().values()}
        kept = {*live, *sorted({*committed, number})[-self.keep_versions :]}
        for old in committed.keys() - kept:
            folder = self._hadoop_path(f"{self.path}/{committed[old]}={old:08d}")
            self._filesystem(folder).delete(folder, True)
