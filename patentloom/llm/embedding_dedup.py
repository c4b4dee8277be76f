"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree splits the vectors again and again at the median of a random projection; vectors
close to a split go to both sides (spill). Trees are fitted on a bounded sample, which sets
only thresholds, and all vectors are then sent down all trees. Vectors that meet in a leaf
with equal labels are compared in double precision, all with all; links found in any tree
are united. A node whose vectors are mostly near each other is not split, whatever its size:
no direction parts a group of near copies without cutting links.

Pairs are counted, not emitted. A pair counts in the first leaf that both vectors share, so
every row carries the leaves before its own; what leaves a comparison is one count per vector
and the links of a spanning forest. Leaves expected to be large are dealt to blocks, and each
pair of blocks is compared by a task of its own.

Equal vectors of a label are one class throughout, so a vector of very many copies costs no
more than a single one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.llm.arrays import U64, mix
from patentloom.llm.components import connected_components
from patentloom.session import ship_package
from patentloom.sinks.files import written

LEAF = pa.schema(
    [("leaf", pa.int32()), ("size", pa.int32()), ("low", pa.int32()), ("high", pa.int32()),
     ("side", pa.int32()), ("before", pa.list_(pa.int32())), ("label", pa.int64()),
     ("rep", pa.int64()), ("copies", pa.int64()), ("vector", pa.list_(pa.float32()))]
)
LEAVES = (
    "leaf int, size int, low int, high int, side int, before array<int>, label long, rep long,"
    " copies long, vector array<float>"
)
#: A link (a, b), or the number n of rows that a links with.
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
#: Rows that leave the planter at once.
ROWS = 20_000


@dataclass(frozen=True)
class Forest:
    """``sample``: most vectors a tree is fitted on; ``leaf``: vectors of a label per leaf aimed at;
    ``spill``: half-width of the overlap in standard deviations of the projection;
    ``dense``: share of near pairs from which a node is not split; ``piece``: vectors of a label
    in a leaf from which it is dealt to blocks; ``block``: vectors compared at once."""

    threshold: float = 0.93
    trees: int = 6
    sample: int = 20_000
    leaf: int = 500
    spill: float = 0.35
    least_sample: int = 32
    dense: float = 0.25
    piece: int = 16_384
    block: int = 1_024
    seed: int = 7


@dataclass
class Tree:
    number: int
    #: node -> (threshold, half-width of the overlap); children of k are 2k and 2k + 1
    splits: dict[int, tuple[float, float]] = field(default_factory=dict)
    #: leaf -> its rows of the sample
    leaves: dict[int, np.ndarray] = field(default_factory=dict)


@dataclass
class Trees:
    """``number``: of a leaf, by tree and node; ``blocks``: of a leaf, where more than one."""

    trees: list[Tree]
    number: dict[tuple[int, int], int]
    blocks: dict[int, int]


def direction(seed: int, tree: int, node: int, size: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, node, size]).standard_normal(size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def is_dense(vectors: np.ndarray, forest: Forest, most: int = 256) -> bool:
    """Whether many pairs of unit vectors reach the threshold, by at most ``most`` of them."""
    some = vectors[np.linspace(0, len(vectors) - 1, min(most, len(vectors))).astype(np.int64)]
    n = len(some)
    near = np.count_nonzero(some @ some.T >= forest.threshold) - n
    return near >= forest.dense * n * (n - 1)


def grow(sample: np.ndarray, each: float, tree: int, forest: Forest) -> Tree:
    """A tree over unit vectors of which each stands for ``each`` vectors."""
    out, todo = Tree(tree), [(1, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        out.leaves[node] = rows
        if len(rows) * each <= forest.leaf or len(rows) < forest.least_sample or node >= 1 << 40:
            continue
        if is_dense(sample[rows], forest):
            continue
        p = sample[rows] @ direction(forest.seed, tree, node, sample.shape[1])
        middle, width = float(np.median(p)), float(p.std() * forest.spill)
        left, right = p <= middle + width, p >= middle - width
        if min(left.sum(), right.sum()) * 20 > 19 * len(rows):
            continue  # no direction that parts them
        out.splits[node] = (middle, width)
        del out.leaves[node]
        todo += [(2 * node, rows[left]), (2 * node + 1, rows[right])]
    return out


def leaves_of(vectors: np.ndarray, tree: Tree, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    todo = [(1, np.arange(len(vectors)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node not in tree.splits:
            yield node, rows
            continue
        middle, width = tree.splits[node]
        p = vectors[rows] @ direction(seed, tree.number, node, vectors.shape[1])
        todo += [(2 * node, rows[p <= middle + width]), (2 * node + 1, rows[p >= middle - width])]


def _trees(sample: np.ndarray, labels: np.ndarray, all_: int, of: int, forest: Forest) -> Trees:
    """A forest over unit vectors: ``all_`` vectors, of ``of`` labels, have been sampled."""
    each = all_ / len(sample)
    grown = [grow(sample, each / max(of, 1), t, forest) for t in range(forest.trees)]
    out = Trees(grown if any(t.splits for t in grown) else grown[:1], {}, {})
    for tree in out.trees:
        for node, rows in tree.leaves.items():
            number = out.number[tree.number, node] = len(out.number)
            most = np.unique(labels[rows], return_counts=True)[1].max(initial=0)
            if most * each > forest.piece:
                out.blocks[number] = int(np.ceil(most * each / forest.piece))
    return out


def _planted(own: pa.RecordBatch, trees: Trees, size: int, seed: int) -> Iterator[pa.RecordBatch]:
    flat = own.column(3).flatten().to_numpy(zero_copy_only=False)
    vectors = _unit(flat.astype(np.float64).reshape(-1, size))
    rows, leaves = [], []
    for tree in trees.trees:
        for node, inside in leaves_of(vectors, tree, seed):
            rows.append(inside)
            leaves.append(np.full(len(inside), trees.number[tree.number, node], np.int64))
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    row, leaf = row[order], leaf[order]
    first = np.searchsorted(row, row)  # where the leaves of the row begin
    blocks = np.array([trees.blocks.get(x, 1) for x in leaf.tolist()], np.int64)
    reps = own.column(1).to_numpy(zero_copy_only=False).astype(U64)
    side = (mix(reps)[row] % blocks.astype(U64)).astype(np.int64)
    ends = np.cumsum(blocks)
    for at in range(0, int(ends[-1]), ROWS):
        nth = np.arange(at, min(at + ROWS, int(ends[-1])))
        k = np.searchsorted(ends, nth, "right")
        other = nth - (ends - blocks)[k]
        counts = k - first[k]
        total = np.append(0, np.cumsum(counts))
        before = leaf[np.arange(total[-1]) + np.repeat(first[k] - total[:-1], counts)]
        part = own.take(pa.array(row[k]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf[k].astype(np.int32)),
             pa.array(np.full(len(k), size, np.int32)),
             pa.array(np.minimum(side[k], other).astype(np.int32)),
             pa.array(np.maximum(side[k], other).astype(np.int32)),
             pa.array(side[k].astype(np.int32)),
             pa.ListArray.from_arrays(
                 pa.array(total.astype(np.int32)), pa.array(before.astype(np.int32))
             ),
             *part.columns],
            schema=LEAF,
        )


def _planter(sent, forest: Forest):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                sizes = np.asarray(batch.column(3).value_lengths())
                for size in np.unique(sizes):
                    own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                    trees = sent.value.get(int(size)) or Trees([Tree(0)], {(0, 1): 0}, {})
                    yield from _planted(own, trees, int(size), forest.seed)

    return run


def shared_before(lists: pa.ListArray) -> np.ndarray:
    """Rows by earlier leaves, 1 where the row lies in the leaf; leaves of a single row are left out."""
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    leaf = lists.flatten().to_numpy(zero_copy_only=False)
    _, of, counts = np.unique(leaf, return_inverse=True, return_counts=True)
    often = counts > 1
    column = np.cumsum(often) - 1
    out = np.zeros((len(lists), int(often.sum())), np.float32)
    out[row[often[of]], column[of[often[of]]]] = 1
    return out


class Spanning:
    """Links that join the rows of a comparison: as many as it takes."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, a: int, others: np.ndarray) -> None:
        sets = self.of[others]
        if (sets == self.of[a]).all():
            return
        new, at = np.unique(sets, return_index=True)
        for other, b in zip(new.tolist(), others[at].tolist(), strict=True):
            if other != self.of[a]:
                self.links.append((a, b))
                self.of[self.of == other] = self.of[a]


def _compare(forest: Forest):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.float64).reshape(len(reps), -1)
        norms = np.sqrt((vectors * vectors).sum(1))
        before = shared_before(table["before"].combine_chunks())
        counts, spanning = np.zeros(len(reps), np.int64), Spanning(len(reps))
        low, high, side = table["low"][0].as_py(), table["high"][0].as_py(), table["side"].to_numpy()
        rows, columns = np.flatnonzero(side == low), np.flatnonzero(side == high)
        if (before.sum(0) == len(reps)).any():
            rows = rows[:0]  # all have met before
        for i in range(0, len(rows), forest.block):
            r = rows[i : i + forest.block]
            for j in range(i if low == high else 0, len(columns), forest.block):
                c = columns[j : j + forest.block]
                near = vectors[r] @ vectors[c].T
                near /= norms[r, None] * norms[None, c]
                near = near >= forest.threshold
                if low == high and i == j:
                    near = np.triu(near, 1)
                if not near.any():
                    continue
                near &= reps[r, None] != reps[None, c]
                if before.shape[1]:
                    near &= before[r] @ before[c].T == 0
                counts[r] += near @ copies[c]
                counts[c] += copies[r] @ near
                for k in np.flatnonzero(near.any(1)):
                    spanning.join(int(r[k]), c[near[k]])
        a, b = np.array(spanning.links, np.int64).reshape(-1, 2).T
        some = np.flatnonzero(counts)
        n = len(some)
        return pa.table(
            [pa.array(np.append(reps[a], reps[some])),
             pa.concat_arrays([pa.array(reps[b], pa.int64()), pa.nulls(n, pa.int64())]),
             pa.concat_arrays([pa.nulls(len(b), pa.int64()), pa.array(counts[some])])],
            schema=FOUND,
        )

    return run


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null, NaN or infinite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def class_links(classes: DataFrame, forest: Forest) -> DataFrame:
    """For classes with columns label, rep, vector and copies: links (a, b) that join what is
    linked, and numbers n of rows that a links with, which are to be summed."""
    spark = classes.sparkSession
    ship_package(spark)
    stats = classes.agg(
        F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")
    ).first()
    sample = (
        classes.select("vector", "label").orderBy(F.xxhash64("rep")).limit(forest.sample).collect()
    )
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row)
    trees = {}
    for size, rows in by_size.items():
        unit = _unit(np.array([row["vector"] for row in rows], np.float64))
        labels = np.array([row["label"] for row in rows], np.int64)
        share = stats["n"] * len(rows) // len(sample)
        trees[size] = _trees(unit, labels, share, stats["labels"], forest)
        for tree in trees[size].trees:
            tree.leaves = {}  # not needed any more
    sent = spark.sparkContext.broadcast(trees)
    planted = classes.select("label", "rep", "copies", "vector").mapInArrow(
        _planter(sent, forest), LEAVES
    )
    keys = ("leaf", "size", "label", "low", "high")
    return planted.groupBy(*keys).applyInArrow(_compare(forest), "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    forest: Forest = Forest(),
) -> DataFrame:
    """Columns vec_id, n_links, component_id and kept, one row per row of ``vectors``.

    Vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least the threshold; vectors of different lengths do not link. Vectors
    that are null, empty, zero, or hold null or non-finite components link with nothing, and
    neither do rows with a null id. A row that is repeated in full counts as one vector.
    Other columns are not read, whatever their names.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<float>").alias("vector"),
        F.col(label).cast("long").alias("label"),
    )
    good = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good_rows = rows.where(good)
    classes = (
        good_rows.groupBy("label", "vector", "vec_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    # One id can stand for different vectors; classes are numbered by label and vector then.
    classes = written(classes, "vector-classes")
    found = written(class_links(classes, forest), "vector-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    linked = (
        found.where("n IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    )
    component = connected_components(links).withColumnRenamed("node", "rep")
    judged = (
        classes.join(linked, "rep", "left")
        .join(component, "rep", "left")
        .select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = rows.where(~good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = good_rows.join(judged, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    return out.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
