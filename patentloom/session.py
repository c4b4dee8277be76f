"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Defaults a job may override through ``conf``. Adaptive execution merges small shuffle
# partitions and splits skewed ones, but cannot widen a narrow start: large jobs pass
# ``shuffle_width``, about one partition per 128 MB of the largest shuffle.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(
    app_name: str, master: str | None = None, shuffle_width: int | None = None, **conf: str
) -> SparkSession:
    """Build or reuse a session with the engine's defaults."""
    if shuffle_width is not None:
        width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        conf = {width: str(shuffle_width), **conf}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Where the setting is absent only a local master may fall back to a temporary
    folder; a cluster without a shared folder is a configuration error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="patentloom-")
    spark.conf.set(CHECKPOINT_KEY, fallback)
    return fallback


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the intermediate tables that were made inside.

    Results are lazy and read those tables, so write or collect them inside too.
    """
    before = len(_made)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(hadoop, _made[before:]):
            path.getFileSystem(conf).delete(path, True)
        del _made[before:]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="patentloom-zip-")) / package.name
    context.addPyFile(
        shutil.make_archive(str(target), "zip", root_dir=package.parent, base_dir=package.name)
    )
    _shipped.add(context.applicationId)
