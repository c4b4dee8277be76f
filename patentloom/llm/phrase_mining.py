"""Collocations by set-oriented mining of occurrence relations (SETM).

The k-th relation tells, for every position where a frequent phrase of k words starts, which
phrase that is. The first one, of the words, is written sorted by piece and position; each
next one is made from the last by a merge join on piece and adjacent position (the phrase
here and the phrase one position on are k + 1 words together), a count per pair, and a
semi-join with the pairs that are frequent. Only what survives is written and extended.

A relation is stored in buckets of some megabytes of text. A bucket keeps its rows packed, one
number per position in sorted order, so that the merge join compares neighbours, and it sends
each different pair once with its count: a phrase that stands everywhere costs one entry per
bucket. Parts of the pair space add the counts and answer with the numbers of the frequent
pairs. Words, languages and phrases are compared by themselves, never by hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentloom.llm.arrays import U64, mix
from patentloom.llm.exchange import Deal, parts_for
from patentloom.session import ship_package
from patentloom.sinks.files import written

#: What a language without a name is called.
NO_LANG = "und"
BLANKS, SEPARATORS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(SEPARATORS)] = 1, 2

OCCURRENCES = "bucket long, local int, lang string, word string, n long, groups binary, breaks binary"
RELATION = "bucket long, groups binary, breaks binary, ids binary"
GROUPS = "id long, head long, tail long, a long"


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    fields = (field.split() for field in schema.split(","))
    return pa.schema([(name, _TYPES[kind]) for name, kind in fields])


def _squeezed(numbers: np.ndarray) -> bytes:
    """Stored form of numbers: their count, and their bytes compressed."""
    raw = np.ascontiguousarray(numbers).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _restored(stored: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(stored[:8], "little")
    return np.frombuffer(pa.decompress(stored[8:], size, "zstd", asbytes=True), kind)


# The first relation.


def _in_buckets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows (lang, text) in tables of about ``size`` bytes of text, a longer text alone."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(sizes.tolist()):
            if have and have + n > size:
                held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, have, at = [], 0, i
            have += n
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; null is empty."""
    whole = pa.concat_arrays(column.cast(pa.large_binary()).fill_null(b"").chunks)
    if not len(whole):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_in_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and whether it is the first of its piece."""
    n = len(data)
    kind = _KIND[data]
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    word = kind == 0
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | head[1:n]
    ends[:-1] &= ~word[1:] | head[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    piece = np.cumsum((kind == 2) | head[:n], dtype=np.int32)[start]
    return start, end, np.diff(piece, prepend=-1) != 0


def _occurrences(table: pa.Table, bucket: int) -> Iterator[pa.RecordBatch]:
    """The words of a bucket with their counts, and a row with all occurrences."""
    schema = _arrow(OCCURRENCES)
    data, offsets = _flat(table.column(1))
    start, end, first = words_in_pieces(data, offsets)
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    letters = low[_KIND[data] == 0]
    places = np.append(0, np.cumsum(end - start)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(letters)]
    ).dictionary_encode()
    langs = table.column(0).combine_chunks().dictionary_encode()
    if isinstance(langs, pa.ChunkedArray):
        langs = pa.concat_arrays(langs.chunks)
    several = max(1, len(langs.dictionary))
    doc = np.searchsorted(offsets, start, "right") - 1
    lang = langs.indices.to_numpy().astype(np.int64)[doc]
    key = words.indices.to_numpy().astype(np.int64) * several + lang
    counts = np.bincount(key, minlength=1)
    own = np.flatnonzero(counts)
    local = np.zeros(len(counts), np.int32)
    local[own] = np.arange(len(own))
    texts = words.dictionary.cast(pa.binary()).view(pa.string())
    nothing = [None] * len(own)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(own), bucket)),
            pa.array(np.arange(len(own)), pa.int32()),
            langs.dictionary.take(pa.array(own % several)).cast(pa.string()),
            texts.take(pa.array(own // several)),
            pa.array(counts[own], pa.int64()),
            pa.array(nothing, pa.binary()),
            pa.array(nothing, pa.binary()),
        ],
        schema=schema,
    )
    row = [bucket, None, None, None, None, _squeezed(local[key]), np.packbits(first).tobytes()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema
    )


def _reader(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bucket = (context.partitionId() if context else 0) << 32
        for table in _in_buckets(batches, size):
            if table.num_rows:
                yield from _occurrences(table, bucket)
                bucket += 1

    return run


def _relation_row(bucket: int, groups: np.ndarray, breaks: bytes, ids: np.ndarray) -> pa.Table:
    row = [bucket, _squeezed(groups), breaks, _squeezed(ids)]
    schema = _arrow(RELATION)
    return pa.table([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)


def _frequent_only(occurrences: pa.Table, kept: pa.Table) -> pa.Table:
    """The occurrences of words that are kept, under new local numbers."""
    if not occurrences.num_rows:
        return _arrow(RELATION).empty_table()
    groups = _restored(occurrences["groups"][0].as_py(), np.int32)
    ids = kept["id"].to_numpy()
    order = np.argsort(ids, kind="stable")  # same local numbers whatever the order of rows
    local = kept["local"].to_numpy()[order]
    renamed = np.full(max(int(groups.max(initial=-1)), int(local.max(initial=-1))) + 1, -1, np.int32)
    renamed[local] = np.arange(len(local))
    bucket = occurrences["bucket"][0].as_py()
    return _relation_row(bucket, renamed[groups], occurrences["breaks"][0].as_py(), ids[order])


# The next relation.


class Pairs:
    """The merge join of a bucket's relation with itself one position on."""

    def __init__(self, groups: np.ndarray, breaks: bytes | None, ids: np.ndarray):
        here, there = groups[:-1], groups[1:]
        both = (here >= 0) & (there >= 0)
        if breaks is not None:  # longer phrases that overlap are in one piece anyway
            both &= ~np.unpackbits(np.frombuffer(breaks, np.uint8), count=len(groups))[1:].astype(bool)
        self.size, self.at = len(groups), np.flatnonzero(both)
        several = max(1, len(ids))
        key = here[self.at].astype(np.int64) * several + there[self.at]
        own, self.which, self.counts = np.unique(key, return_inverse=True, return_counts=True)
        self.head, self.tail = ids[own // several], ids[own % several]

    def deal(self, parts: int) -> Deal:
        return Deal(mix(self.head.astype(U64)) + self.tail.astype(U64), parts)


def _pairs_of(row: dict) -> Pairs:
    groups, ids = _restored(row["groups"], np.int32), _restored(row["ids"], np.int64)
    return Pairs(groups, row["breaks"], ids)


def _asker(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                pairs = _pairs_of(row)
                if not len(pairs.counts):
                    continue
                wide = 4 if int(max(pairs.head.max(), pairs.tail.max())) < 1 << 32 else 8
                deal = pairs.deal(parts)
                head, tail, n = (x[deal.order] for x in (pairs.head, pairs.tail, pairs.counts))
                kinds, blobs = [], []
                for a, b in zip(deal.cuts.tolist(), deal.ends.tolist(), strict=True):
                    size = 1 if n[a:b].max() < 256 else 8
                    kinds.append(16 * wide + size)
                    ids = np.concatenate([head[a:b], tail[a:b]]).astype(f"<u{wide}")
                    blobs.append(ids.tobytes() + n[a:b].astype(f"<u{size}").tobytes())
                columns = [
                    pa.array(deal.parts, pa.int32()),
                    pa.array([row["bucket"]] * len(blobs), pa.int64()),
                    pa.array(kinds, pa.int32()),
                    pa.array(blobs, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=ASKED)

    return run


ASKS = "part int, bucket long, kind int, blob binary"
ASKED = _arrow(ASKS)


def _unpacked(kind: int, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    wide, size = divmod(kind, 16)
    n = len(blob) // (2 * wide + size)
    ids = np.frombuffer(blob, f"<u{wide}", 2 * n).astype(np.int64)
    return ids[:n], ids[n:], np.frombuffer(blob, f"<u{size}", n, 2 * wide * n).astype(np.int64)


def _counter(parts: int, least: int):
    """Answers of a part: per asked pair its place among the frequent ones or -1 (kind 0), and
    the frequent pairs (kind 1)."""

    def run(asked: pa.Table) -> pa.Table:
        part = asked["part"][0].as_py()
        asks = [
            _unpacked(k, b)
            for k, b in zip(asked["kind"].to_pylist(), asked["blob"].to_pylist(), strict=True)
        ]
        head, tail, n = (np.concatenate(x) for x in zip(*asks, strict=True))
        order = np.lexsort((tail, head))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(head[order]) != 0) | (np.diff(tail[order]) != 0)
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first)
        often = total >= least
        place = np.where(often, np.cumsum(often) - 1, -1).astype("<i4")
        reply = np.empty(len(order), "<i4")
        reply[order] = place[np.cumsum(new) - 1]
        buckets, blobs, at = asked["bucket"].to_pylist(), [], 0
        for ask in asks:
            blobs.append(reply[at : at + len(ask[0])].tobytes())
            at += len(ask[0])
        top = order[first[often]]
        ids = part + parts * np.arange(len(top), dtype=np.int64)
        found = np.stack([ids, head[top], tail[top], total[often]], 1).astype("<i8").tobytes()
        return pa.table(
            [
                pa.array([part] * (len(blobs) + 1), pa.int32()),
                pa.array([*buckets, -1], pa.int64()),
                pa.array([0] * len(blobs) + [1], pa.int32()),
                pa.array([*blobs, found], pa.binary()),
            ],
            schema=ASKED,
        )

    return run


def _found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(GROUPS)
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            rows = np.frombuffer(blob, "<i8").reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T.copy()], schema=schema)


def _extender(parts: int):
    def run(relation: pa.Table, replies: pa.Table) -> pa.Table:
        if not relation.num_rows:
            return _arrow(RELATION).empty_table()
        row = relation.to_pylist()[0]
        pairs = _pairs_of(row)
        deal = pairs.deal(parts)
        ids = np.full(len(pairs.counts), -1, np.int64)
        where = {int(p): (a, b) for p, a, b in zip(deal.parts, deal.cuts, deal.ends, strict=True)}
        for part, blob in zip(replies["part"].to_pylist(), replies["blob"].to_pylist(), strict=True):
            a, b = where[part]
            place = np.frombuffer(blob, "<i4").astype(np.int64)
            ids[deal.order[a:b]] = np.where(place >= 0, place * parts + part, -1)
        often = ids >= 0
        local = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        groups = np.full(pairs.size, -1, np.int32)
        groups[pairs.at] = local[pairs.which]
        return _relation_row(row["bucket"], groups, None, ids[often])

    return run


# Phrases.


def _scored(cut: Column, l: Column, r: Column) -> Column:  # noqa: E741
    # Decimals: the product may pass 64 bits.
    a, both = F.col("a").cast("decimal(19,0)"), (l.cast("decimal(19,0)") + r.cast("decimal(19,0)"))
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a, both)
    return F.struct(score.alias("score"), cut.alias("cut"), l.alias("l"), r.alias("r"))


def _with_cut(phrases: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase: columns score, cut, l and r."""
    size = F.size("words")

    def cut(k: Column) -> Column:
        return _scored(k, F.element_at("heads", k), F.element_at("tails", size - k))

    cuts = F.transform(F.sequence(F.lit(1), size - 1), cut)
    return phrases.select("*", F.array_min(cuts).alias("best")).select("*", "best.*").drop("best")


def _grown(groups: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases of one word more: their words, and the counts of all their heads and tails."""
    head = phrases.select(
        F.col("id").alias("head"), "lang", "words", "heads", F.size("words").alias("had"),
        F.col("within").alias("head_within"),
    )
    tail = phrases.select(
        F.col("id").alias("tail"), F.element_at("words", -1).alias("last"), "tails",
        F.col("within").alias("tail_within"),
    )
    return groups.join(head, "head").join(tail, "tail").select(
        "id",
        "lang",
        F.concat("words", F.array("last")).alias("words"),
        "a",
        F.concat("heads", F.array("a")).alias("heads"),
        F.concat("tails", F.array("a")).alias("tails"),
        # (words, id) of all phrases inside of two words and more
        F.filter(
            F.array_union(
                F.array_union("head_within", "tail_within"),
                F.array(*(F.struct(F.col("had").alias("size"), F.col(c).alias("id")) for c in ("head", "tail"))),
            ),
            lambda inside: inside["size"] > 1,
        ).alias("within"),
    )


def _ranked(phrases: DataFrame, totals: DataFrame, share: int, top: int) -> DataFrame:
    inside = (
        phrases.select(F.explode("within").alias("of"), F.col("a").alias("longer"))
        .groupBy("of.size", "of.id")
        .agg(F.max("longer").alias("longer"))
    )
    scored = _with_cut(phrases.withColumn("size", F.size("words")))
    kept = scored.join(inside, ["size", "id"], "left").where(
        F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))
    )
    named = kept.withColumn("phrase", F.array_join("words", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def mine_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 4,
    least: int = 30,
    share: int = 80,
    top: int = 2000,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z in lower case, are cut at ``.,;:!?`` and 0x0A-0x0D into pieces and those at
    blanks and tabs into words. Phrases have 2 to ``longest`` words and occur at least
    ``least`` times (a) in pieces of their language. Of the cuts in two, that with the least
    ``floor(2000000 * a / (l + r))`` counts, then the shortest first part; l and r are how often
    both parts occur. A phrase goes if a longer one around it occurs ``share`` percent as often.
    Equal scores rank by a, then by the bytes of the phrase. n is the number of words.

    A null text is empty, a null language is ``und`` (as is a language of that name); repeated
    rows and ids all count, and columns other than the two named are not read. Relations and
    frequent phrases are stored in the shared folder, level by level, when this is called; the
    ranking is lazy. A bucket holds ``bucket_bytes`` of text or one longer text.
    """
    if longest < 2 or least < 1 or top < 1:
        raise ValueError("phrases have two words or more, and occur")
    spark = docs.sparkSession
    ship_package(spark)
    read = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col(text).cast("binary").alias("text"),
    )
    occurrences = written(read.mapInArrow(_reader(bucket_bytes), OCCURRENCES), "occurrences")
    words = occurrences.where("local IS NOT NULL")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = words.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    numbered = written(counted.withColumn("row", F.monotonically_increasing_id()), "words")
    # Row numbers made dense: the row within its task, times the tasks.
    tasks = (numbered.agg(F.max(F.shiftright("row", 33))).first()[0] or 0) + 1
    within = F.col("row").bitwiseAND((1 << 33) - 1)
    frequent = numbered.select((within * tasks + F.shiftright("row", 33)).alias("id"), "lang", "word", "a")
    kept = words.join(frequent, ["lang", "word"]).select(
        F.col("bucket").alias("of"), "local", "id"
    )
    packed = occurrences.where("local IS NULL").select("bucket", "groups", "breaks")
    relation = written(
        packed.groupBy("bucket").cogroup(kept.groupBy("of")).applyInArrow(_frequent_only, RELATION),
        "relation",
    )
    phrases = frequent.select(
        "id", "lang", F.array("word").alias("words"), "a", F.array("a").alias("heads"),
        F.array("a").alias("tails"), F.expr("cast(array() AS array<struct<size: int, id: bigint>>)").alias("within"),
    )
    entries = totals.agg(F.sum("n")).first()[0] or 0
    found: list[DataFrame] = []
    for size in range(2, longest + 1):
        parts = parts_for(spark, entries, 2 << 20)
        asked = relation.mapInArrow(_asker(parts), ASKS)
        answered = written(
            asked.groupBy("part").applyInArrow(_counter(parts, least), ASKS), f"pairs-{size}"
        )
        groups = answered.where("kind = 1").select("blob").mapInArrow(_found, GROUPS)
        phrases = written(_grown(groups, phrases), f"phrases-{size}")
        found.append(phrases)
        if size < longest:
            replies = answered.where("kind = 0").select("bucket", "part", "blob")
            relation = written(
                relation.groupBy("bucket")
                .cogroup(replies.groupBy("bucket"))
                .applyInArrow(_extender(parts), RELATION),
                "relation",
            )
    everything = found[0]
    for more in found[1:]:
        everything = everything.unionByName(more)
    return _ranked(everything, totals, share, top)
