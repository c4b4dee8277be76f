"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.sinks.files import written

PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Union:
    """Union-find over any hashable nodes; the least node of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        path = []
        while (p := parent.setdefault(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            parent[y] = x
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        return True


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as (node, least node of its set): as many as it has nodes."""
    sets = Union()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(a, b)
    nodes = [x for x in sets.parent if sets.root(x) != x]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([sets.root(x) for x in part], pa.int64())],
            schema=PAIR,
        )


def contracted(links: DataFrame) -> DataFrame:
    """Fewer links (a > b) with the same components, without a shuffle."""
    return links.select("a", "b").mapInArrow(_forest, "a long, b long")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    rest = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Columns ``node`` and ``component`` (its least node) for every node with a link.

    ``links`` has long columns ``a`` and ``b``; nulls and loops are left out, repeated and
    reversed links do no harm. Each task first reduces its links to a forest; then large and
    small stars alternate until nothing changes, which takes about log(n) rounds. Each round
    is written to the shared folder; minima combine before the shuffle, and joins at
    much-linked nodes can be split.
    """
    spark = links.sparkSession
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = written(contracted(clean), "links")
    before = None
    for _ in range(most_rounds):
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")
        ).first()
        if not state["n"] or state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        now = written(_small_star(_large_star(now)).distinct(), "links")
    raise RuntimeError(f"no fixed point after {most_rounds} rounds of {spark.sparkContext.appName}")
