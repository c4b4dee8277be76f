"""N-gram Jaccard join with signature trees.

Documents link when their sets of word shingles have a Jaccard similarity of 0.8 or more.

1. Documents with equal sets are one from here on (two 64-bit sums of the set's hashes).
2. A document can only link when 80 % of its shingles stand in another document too; one bit
   per shingle from the owners of the hash space leaves few documents (``exchange``).
3. Candidates that agree on a least hash form a group. In each group the documents are the
   leaves of a signature tree, by size, whose nodes hold the OR of bitmaps of shingles and
   the range of set sizes. Dual traversal from (root, root) drops node pairs whose largest
   possible overlap is too small, or which lie in one component already, and verifies what
   remains on the sets themselves.
4. What that leaves is found by prefixes: a linked pair shares one of the least shared
   hashes of both. Only hashes at which different components still meet are looked at, by
   dual traversal over bitmaps; surviving pairs are verified on the sets.

Groups hold each different set once, are cut where they are large, and yield no more links
than join components, so copies and near copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.llm import exchange as X
from patentloom.llm.arrays import (
    NULL_ID,
    U64,
    Texts,
    mix,
    prefix_hashes,
    range_hashes,
    texts_of,
    words_of,
)
from patentloom.llm.components import connected_components
from patentloom.sinks.files import written
from patentloom.session import ship_package

REP, FLAGS = 7, 0
SETS = "doc long, n int, bits binary, hashes binary"
FACTS = "bucket int, doc long, n int, s1 long, s2 long"


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity; ``words``: shingle size; ``bits``: of a bitmap;
    ``fan``: children of a tree node; ``group``: documents compared in one group;
    ``orders``: hash orders by which step 3 groups."""

    percent: int = 80
    words: int = 5
    bits: int = 2048
    fan: int = 16
    group: int = 2048
    orders: int = 2
    bucket_bytes: int = 2 << 20


@dataclass
class Shingles:
    """Distinct shingle hashes of every document, sorted within the document."""

    hashes: np.ndarray
    offsets: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i] : self.offsets[i + 1]]


def shingles_of(texts: Texts, size: int) -> Shingles:
    words = words_of(texts, lower=True)
    counts = np.diff(words.first)
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = words.first[:-1][doc] + nth
    length = np.minimum(counts[doc], size)
    hashes = range_hashes(prefix_hashes(words.hash), start, start + length)
    hashes = mix(hashes + length.astype(U64) * U64(0xD6E8FEB86659FD93))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[new], hashes[new]
    return Shingles(hashes, np.searchsorted(doc, np.arange(len(texts) + 1)))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(U64(0), np.cumsum(values, dtype=U64))
    return (total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)


def _facts(settings: Settings):
    schema = pa.schema(
        [("bucket", pa.int32()), ("doc", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()),
         ("s2", pa.int64())]
    )

    def run(table: pa.Table) -> pa.Table:
        texts = texts_of(table)
        sets = shingles_of(texts, settings.words)
        return pa.table(
            [
                pa.array(np.full(len(texts), X.bucket_of(table), np.int32)),
                pa.array(texts.ids),
                pa.array(np.diff(sets.offsets).astype(np.int32)),
                pa.array(_sums(mix(sets.hashes), sets.offsets)),
                pa.array(_sums(mix(sets.hashes ^ U64(0x5851F42D4C957F2D)), sets.offsets)),
            ],
            schema=schema,
        )

    return run


def _representatives(replies: pa.Table, texts: Texts, sets: Shingles) -> np.ndarray:
    """Indexes of the documents that stand for their set, one per id and set."""
    blob = b"".join(b for _, _, b in X.blobs_by(replies, REP))
    chosen = np.frombuffer(blob, "<i8").reshape(-1, 2)
    if not len(chosen):
        return np.zeros(0, np.int64)
    s1 = _sums(mix(sets.hashes), sets.offsets)
    wanted = set(map(tuple, chosen.tolist()))
    picked, seen = [], set()
    for i, key in enumerate(zip(texts.ids.tolist(), s1.tolist(), strict=True)):
        if key in wanted and key not in seen:
            seen.add(key)
            picked.append(i)
    return np.array(picked, np.int64)


def _members(sets: Shingles, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``sets.hashes`` of the documents, and the start of each."""
    sizes = sets.offsets[docs + 1] - sets.offsets[docs]
    starts = np.append(0, np.cumsum(sizes))
    place = np.arange(starts[-1]) + np.repeat(sets.offsets[docs] - starts[:-1], sizes)
    return place, starts


def _ask(settings: Settings, parts: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return X.empty()
        texts = texts_of(table)
        sets = shingles_of(texts, settings.words)
        place, _ = _members(sets, _representatives(replies, texts, sets))
        keys = np.unique(sets.hashes[place])
        deal = X.Deal(keys, parts)
        return deal.pack(deal.remainders(), X.bucket_of(table), FLAGS)

    return run


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, bool)
    out[(hashes % U64(bits)).astype(np.int64)] = True
    return np.packbits(out)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with any set it links with."""
    return -(-n * percent // 100)


def _candidates(settings: Settings, parts: int):
    schema = pa.schema(
        [("doc", pa.int64()), ("n", pa.int32()), ("bits", pa.binary()), ("hashes", pa.binary())]
    )

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        texts = texts_of(table)
        sets = shingles_of(texts, settings.words)
        docs = _representatives(replies, texts, sets)
        place, starts = _members(sets, docs)
        keys, of, counts = np.unique(sets.hashes[place], return_inverse=True, return_counts=True)
        flags = replies.filter(pc.equal(replies["kind"], FLAGS))
        shared = (X.Deal(keys, parts).unpack_bits(flags) | (counts > 1))[of]
        rows = []
        for i, doc in enumerate(docs):
            own, n = shared[starts[i] : starts[i + 1]], int(starts[i + 1] - starts[i])
            if own.sum() >= least_overlap(n, settings.percent):
                hashes = sets.of(doc)[own]
                rows.append((
                    int(texts.ids[doc]), n, bitmap(hashes, settings.bits).tobytes(), hashes.tobytes()
                ))
        if not rows:
            return schema.empty_table()
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=schema)

    return run


# Signature trees.


class Node:
    """``docs``: indexes below; ``kids``: none for a node of leaves."""

    __slots__ = ("docs", "kids", "bits", "low", "high")

    def __init__(self, docs: np.ndarray, kids: list[Node], bits: np.ndarray, sizes: np.ndarray):
        self.docs, self.kids, self.bits = docs, kids, bits
        self.low, self.high = int(sizes.min()), int(sizes.max())


def signature_tree(bits: np.ndarray, sizes: np.ndarray, order: np.ndarray, fan: int) -> Node:
    level = []
    for i in range(0, len(order), fan):
        docs = order[i : i + fan]
        level.append(Node(docs, [], np.bitwise_or.reduce(bits[docs]), sizes[docs]))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), fan):
            kids = level[i : i + fan]
            docs = np.concatenate([k.docs for k in kids])
            above.append(Node(docs, kids, np.bitwise_or.reduce([k.bits for k in kids]), sizes[docs]))
        level = above
    return level[0]


def _weight(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def dual_traversal(
    bits: np.ndarray, shared: np.ndarray, sizes: np.ndarray, root: np.ndarray, settings: Settings
) -> Iterator[tuple[int, int]]:
    """Pairs that may link, with different ``root`` at that moment (the caller updates it).

    A set of n shingles, m of them shared, overlaps another by at most m less the bits it
    has and the other lacks: each such bit stands for a shingle of its own.
    """
    percent = settings.percent
    order = np.lexsort((root, sizes))
    tree = signature_tree(bits, sizes, order, settings.fan)
    todo = [(tree, tree)]
    while todo:
        a, b = todo.pop()
        if a.high * 100 < percent * b.low or b.high * 100 < percent * a.low:
            continue
        ra, rb = root[a.docs], root[b.docs]
        if ra[0] == rb[0] and (ra == ra[0]).all() and (rb == rb[0]).all():
            continue
        if a.kids or b.kids:
            if a is b:
                kids = a.kids
                todo += [(kids[j], kids[i]) for i in range(len(kids)) for j in range(i + 1)]
            elif a.kids and (not b.kids or len(a.docs) >= len(b.docs)):
                todo += [(kid, b) for kid in a.kids if _may(kid, b, bits, shared, sizes, percent)]
            else:
                todo += [(a, kid) for kid in b.kids if _may(a, kid, bits, shared, sizes, percent)]
            continue
        i, j = np.meshgrid(a.docs, b.docs, indexing="ij")
        keep = (root[i] != root[j]) & ((i < j) if a is b else np.ones(i.shape, bool))
        i, j = i[keep], j[keep]
        most = np.minimum(
            shared[i] - _weight(bits[i] & ~bits[j]), shared[j] - _weight(bits[j] & ~bits[i])
        )
        ok = most * (100 + percent) >= percent * (sizes[i] + sizes[j])
        for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
            if root[x] != root[y]:
                yield x, y


def _may(a: Node, b: Node, bits, shared, sizes, percent: int) -> bool:
    """Whether any document below ``a`` can overlap enough with what is below ``b``."""
    if a.high * 100 < percent * b.low or b.high * 100 < percent * a.low:
        return False
    most = shared[a.docs] - _weight(bits[a.docs] & ~b.bits)
    return bool((most * 100 >= percent * sizes[a.docs]).any())


def linked(x: np.ndarray, y: np.ndarray, n: int, m: int, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * (100 + percent) >= percent * (n + m)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _matrix(column: pa.ChunkedArray, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, bits // 8)


def _different_sets(table: pa.Table, column: str) -> pa.Array:
    """First row of every (doc, n, column), in order of the documents."""
    seen: dict[tuple, int] = {}
    keys = zip(*(table[c].to_pylist() for c in ("doc", "n", column)), strict=True)
    for row, key in enumerate(keys):
        seen.setdefault(key, row)
    return pa.array([seen[key] for key in sorted(seen)], pa.int64())


def _group_links(settings: Settings):
    """Links that join the components within a group whose sets are at hand."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(_different_sets(table, "hashes"))
        docs, root = np.unique(table["doc"].to_numpy(), return_inverse=True)
        if len(docs) < 2:
            return LINKS.empty_table()
        docs = docs[root]  # of each set: an id may have several, which are one node
        sets = [np.frombuffer(b, U64) for b in table["hashes"].to_pylist()]
        sizes = table["n"].to_numpy().astype(np.int64)
        shared = np.array([len(s) for s in sets], np.int64)
        found = []
        bits = _matrix(table["bits"], settings.bits)
        for x, y in dual_traversal(bits, shared, sizes, root, settings):
            if linked(sets[x], sets[y], int(sizes[x]), int(sizes[y]), settings.percent):
                found.append((int(docs[x]), int(docs[y])))
                root[root == root[y]] = root[x]
        if not found:
            return LINKS.empty_table()
        return pa.table([list(c) for c in zip(*found, strict=True)], schema=LINKS)

    return run


def _least_hashes(settings: Settings):
    """Each candidate once per hash order, with the least hash of its set in that order."""
    schema = pa.schema(
        [("key", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("bits", pa.binary()),
         ("hashes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(b, U64) for b in batch.column(3).to_pylist()]
            for k in range(settings.orders):
                salt = U64((0x2545F4914F6CDD1D * (k + 1)) & 0xFFFFFFFFFFFFFFFF)
                keys = [int(mix(s ^ salt).min().view(np.int64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), *batch.columns], schema=schema
                )

    return run


def _prefixes(settings: Settings):
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for doc, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = np.frombuffer(blob, U64)  # sorted
                own = own[: len(own) - least_overlap(n, settings.percent) + 1]
                keys.append(own.view(np.int64))
                docs.append(np.full(len(own), doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(docs))], schema=schema
            )

    return run


def _possible(settings: Settings):
    """Pairs of different components that bitmaps cannot rule out."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(_different_sets(table, "bits"))
        docs = table["doc"].to_numpy()
        root = table["component"].to_numpy()
        sizes, shared = (table[c].to_numpy().astype(np.int64) for c in ("n", "shared"))
        bits = _matrix(table["bits"], settings.bits)
        pairs = list(dual_traversal(bits, shared, sizes, root, settings))
        found = [tuple(sorted((int(docs[x]), int(docs[y])))) for x, y in pairs]
        if not found:
            return LINKS.empty_table()
        return pa.table([list(c) for c in zip(*found, strict=True)], schema=LINKS)

    return run


def _verified(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
            ok = [
                linked(np.frombuffer(p, U64), np.frombuffer(q, U64), i, j, settings.percent)
                for i, j, p, q in zip(n, m, x, y, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(s, ok, strict=True) if k], pa.int64()) for s in (a, b)],
                schema=LINKS,
            )

    return run


def candidate_links(sets: DataFrame, settings: Settings) -> DataFrame:
    """Links that connect all components of the candidates (``SETS``, a stored table)."""
    keyed = sets.mapInArrow(
        _least_hashes(settings), "key long, doc long, n int, bits binary, hashes binary"
    )
    # The groups' sizes: those of one are left out, large ones are cut, and the cuts of a
    # group share its first document, so that near copies of it are joined at once.
    least = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("doc").alias("pivot"))
    cut = F.ceil(F.col("size") / settings.group).cast("int")
    grouped = (
        keyed.join(least.where("size > 1"), "key")
        .withColumn("cuts", cut)
        .withColumn(
            "cut",
            F.explode(
                F.when(F.col("doc") == F.col("pivot"), F.sequence(F.lit(0), F.col("cuts") - 1))
                .otherwise(F.array(F.pmod(F.xxhash64("doc"), F.col("cuts")).cast("int")))
            ),
        )
        .select("key", "cut", "doc", "n", "bits", "hashes")
    )
    near = grouped.groupBy("key", "cut").applyInArrow(_group_links(settings), "a long, b long")
    near = written(near, "near-links")
    labels = connected_components(near)
    known = sets.select("doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
        "doc", F.coalesce("component", "doc").alias("component")
    )
    prefixes = sets.select("doc", "n", "hashes").mapInArrow(_prefixes(settings), "key long, doc long")
    entries = written(prefixes.join(known, "doc"), "prefix-entries")
    mixed = entries.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
    ).where("low <> high")
    facts = sets.select("doc", "n", "bits", (F.length("hashes") / 8).cast("int").alias("shared"))
    cuts = F.ceil(F.col("size") / settings.group).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("cuts")).cast("int")
    both = F.transform(
        F.sequence(F.lit(0), F.col("cuts") - 1),
        lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")),
    )
    blocks = (
        entries.join(mixed.select("key", "size"), "key")
        .withColumn("cuts", cuts)
        .withColumn("own", own)
        .withColumn("cut", F.explode(both))
        .select("key", "cut.i", "cut.j", "doc", "component")
        .join(facts, "doc")
    )
    pairs = blocks.groupBy("key", "i", "j").applyInArrow(_possible(settings), "a long, b long")
    side = sets.select("doc", "n", "hashes")
    rest = (
        pairs.distinct()
        .join(side.select(F.col("doc").alias("a"), F.col("n"), F.col("hashes").alias("x")), "a")
        .join(
            side.select(F.col("doc").alias("b"), F.col("n").alias("m"), F.col("hashes").alias("y")),
            "b",
        )
        .select("a", "b", "n", "m", "x", "y")
        .mapInArrow(_verified(settings), "a long, b long")
    )
    return near.unionByName(rest)


def link_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Columns doc_id, n_shingles and component_id (least id reachable by links).

    Words are runs of characters other than blank and U+0009 to U+000D, A-Z lower-cased. A
    document's set holds its different shingles of five words; with fewer words the whole is
    one shingle; without any the set is empty and links with nothing. Two documents link when
    100 * intersection >= percent * union. One row comes out per row that goes in. Rows with
    a null id link with nothing and have no component; rows with equal ids are one node of
    the graph with several sets. Other columns are not read, whatever their names.
    """
    ship_package(docs.sparkSession)
    size = X.total_bytes(docs, text)
    dealt = X.bucketed(docs, doc_id, text, size // settings.bucket_bytes + 1)
    parts = X.parts_for(docs.sparkSession, size / 6)
    facts = written(X.per_bucket(dealt, _facts(settings), FACTS), "shingle-facts")
    named = facts.where((F.col("n") > 0) & (F.col("doc") != int(NULL_ID)))
    classes = named.groupBy("n", "s1", "s2").agg(F.min(F.struct("doc", "bucket")).alias("first"))
    chosen = classes.select(F.col("first.bucket").alias("bucket"), "s1", F.col("first.doc").alias("doc"))
    reps = chosen.groupBy("bucket").applyInArrow(_pack_representatives, X.PACKED)
    asked = X.with_replies(dealt, reps, _ask(settings, parts))
    flags = X.seen_elsewhere(asked)
    sets = written(
        X.with_replies(dealt, reps.unionByName(flags), _candidates(settings, parts), SETS),
        "candidate-sets",
    )
    links = candidate_links(sets, settings)
    first = classes.select("n", "s1", "s2", F.col("first.doc").alias("rep"))
    members = named.join(first, ["n", "s1", "s2"]).select("doc", "rep")
    copies = members.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    label = connected_components(links.unionByName(copies)).withColumnRenamed("node", "doc")
    out = facts.select("doc", "n").join(label, "doc", "left")
    known = F.col("doc") != int(NULL_ID)
    return out.select(
        F.when(known, F.col("doc")).alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(known, F.coalesce("component", "doc")).alias("component_id"),
    )


def _pack_representatives(table: pa.Table) -> pa.Table:
    rows = np.zeros((table.num_rows, 2), "<i8")
    rows[:, 0], rows[:, 1] = table["doc"].to_numpy(), table["s1"].to_numpy()
    row = [[0], [X.bucket_of(table)], [REP], [rows.tobytes()]]
    return pa.table(row, schema=X.SCHEMA)
