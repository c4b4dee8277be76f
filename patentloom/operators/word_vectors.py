"""Word and document vectors learnt from a corpus by random indexing.

Every word has an index vector of a few +1 and -1 at places that its digest names, so it needs
no table. The vector of a word is the sum of the index vectors of its neighbours over all
texts: words of like contexts come to lie near each other. All sums are of integers, so
the vectors do not depend on the order of work. Spark cuts the texts into words, shuffles and
sorts; sums over ``DIMENSIONS`` places are taken in Arrow batches, since an expression per place
makes generated methods too large for the JVM to compile.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.functions.text import STOP_WORDS, tokens, without_stop_words
from patentloom.operators.joins import frequency_lookup
from patentloom.operators.keywords import grouped_terms
from patentloom.operators.ranking import top_k_per_group
from patentloom.session import ship_package

DIMENSIONS = 64
#: Places of an index vector that are not 0, a byte of the digest each (two may coincide).
NONZERO = 4
#: The largest component of a stored vector: sums of any corpus fit into 64 bits then.
SCALE = 127
#: Words whose contexts are summed together: bounds the table of sums, and a frequent word is
#: one row of each before anything is shuffled.
WORDS_AT_ONCE = 1_000_000
#: Rows of a batch that leaves Python.
ROWS_AT_ONCE = 10_000
#: Types of stored sums.
WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def index_entries(terms: pa.Array) -> np.ndarray:
    """Per term the leading bytes of its digest: the dimension and the sign of each entry."""
    digests = (md5(t).digest()[:NONZERO] for t in terms.cast(pa.binary()).to_pylist())
    return np.frombuffer(b"".join(digests), np.uint8).reshape(len(terms), NONZERO)


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``WORDS_AT_ONCE`` words; a longer text stands alone."""
    ends, start = np.cumsum(lengths), 0
    while start < len(ends):
        before = ends[start] - lengths[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
        yield start, stop
        start = stop


def _narrowed(sums: np.ndarray) -> pa.Array:
    """Rows of integers as bytes, each row in the narrowest type that holds it."""
    most = np.maximum(sums.max(axis=1), -(sums.min(axis=1) + 1))
    width = sum((most > np.iinfo(t).max).astype(np.int8) for t in WIDTHS[:-1])
    out: list = [None] * len(sums)
    for i, kind in enumerate(WIDTHS):
        at = np.flatnonzero(width == i)
        if len(at):
            flat, size = sums[at].astype(kind).tobytes(), DIMENSIONS * np.dtype(kind).itemsize
            for k, row in enumerate(at.tolist()):
                out[row] = flat[k * size : (k + 1) * size]
    return pa.array(out, pa.binary())


def _widened(rows: pa.Array) -> np.ndarray:
    """What ``_narrowed`` made, as 64-bit integers."""
    lengths = pc.binary_length(rows).to_numpy(zero_copy_only=False)
    out = np.empty((len(rows), DIMENSIONS), np.int64)
    for kind in WIDTHS:
        at = np.flatnonzero(lengths == DIMENSIONS * np.dtype(kind).itemsize)
        if len(at):
            taken = b"".join(rows.take(pa.array(at)).to_pylist())
            out[at] = np.frombuffer(taken, kind).reshape(len(at), DIMENSIONS)
    return out


def _context_sums(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(term, sums) per slice of texts from batches of word arrays."""

    def sums_of(words: pa.Array) -> pa.RecordBatch | None:
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        terms, place = coded.dictionary, coded.indices.to_numpy()
        if not len(terms):
            return None
        text = np.repeat(np.arange(len(lengths)), lengths)
        entries = index_entries(terms)
        dims = (entries % DIMENSIONS).astype(np.int64)
        few = 2 * window * NONZERO * len(place) < 2**31
        signs = np.where(entries & DIMENSIONS, 1, -1).astype(np.int32 if few else np.int64)
        sums = np.zeros(len(terms) * DIMENSIONS, signs.dtype)
        met = np.zeros(len(terms), bool)
        for offset in range(1, window + 1):
            near = np.flatnonzero(text[offset:] == text[:-offset])
            a, b = place[near].astype(np.int64), place[near + offset].astype(np.int64)
            met[a] = met[b] = True
            for term, other in ((a, b), (b, a)):
                for i in range(NONZERO):
                    np.add.at(sums, term * DIMENSIONS + dims[other, i], signs[other, i])
        at = np.flatnonzero(met)
        rows = sums.reshape(-1, DIMENSIONS)[at]
        columns = [terms.take(pa.array(at)), _narrowed(rows)]
        return pa.RecordBatch.from_arrays(columns, ["term", "sums"]) if len(at) else None

    def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            for start, stop in _slices(lengths):
                found = sums_of(words.slice(start, stop - start))
                if found is not None:
                    for at in range(0, found.num_rows, ROWS_AT_ONCE):
                        yield found.slice(at, ROWS_AT_ONCE)

    return context_sums


def _scaled(c: np.ndarray) -> np.ndarray:
    """The greatest absolute component becomes ``SCALE``, others are cut to integers."""
    most = np.maximum(np.abs(c).max(axis=1, keepdims=True), 1)
    return np.sign(c) * (np.abs(c) * SCALE // most)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, vector) from (term, sums) rows in the order of their terms.

    Only the sums of the last term wait for the next batch.
    """

    def rows(terms: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
        # A component fits a byte.
        packed = _narrowed(_scaled(sums))
        return pa.RecordBatch.from_arrays([terms, packed], ["term", "vector"])

    last, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        terms, sums = batch.column(0), _widened(batch.column(1))
        changes = pc.not_equal(terms.slice(1), terms.slice(0, len(terms) - 1))
        starts = np.concatenate([[0], np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1])
        heads, sums = terms.take(pa.array(starts)), np.add.reduceat(sums, starts, axis=0)
        if last is not None:
            if last[0].equals(heads[0]):
                sums[0] += held[0]
            else:
                yield rows(last, held)
        yield rows(heads.slice(0, len(heads) - 1), sums[:-1])
        last, held = heads.slice(len(heads) - 1), sums[-1:]
    if last is not None:
        yield rows(last, held)


def kept_words(text: Column, stop_words: Sequence[str]) -> Column:
    return without_stop_words(tokens(F.coalesce(text, F.lit(""))), list(stop_words))


def packed_vectors(
    docs: DataFrame, text_column: str, window: int, stop_words: Sequence[str]
) -> DataFrame:
    """(term, vector) as in ``word_vectors``, a vector in ``DIMENSIONS`` signed bytes."""
    ship_package(docs.sparkSession)
    words = docs.select(kept_words(F.col(text_column), stop_words).alias("w"))
    sums = words.mapInArrow(_context_sums(window), "term string, sums binary")
    by_term = sums.repartition("term").sortWithinPartitions("term")
    return by_term.mapInArrow(_merged, "term string, vector binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _widened(batch.column(1)).astype(np.int32).ravel()
        offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * DIMENSIONS
        vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        yield pa.RecordBatch.from_arrays([batch.column(0), vectors], ["term", "vector"])


def word_vectors(
    docs: DataFrame,
    text_column: str = "summary_text",
    window: int = 2,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """(term, vector): for every word with a neighbour, ``DIMENSIONS`` integers.

    The greatest absolute component is scaled to ``SCALE``, others are cut to integers.
    """
    packed = packed_vectors(docs, text_column, window, stop_words)
    return packed.mapInArrow(_unpacked, "term string, vector array<int>")


def doc_numbers(ids: pa.Array) -> np.ndarray:
    """Equal ids, and nulls, have equal numbers."""
    return ids.dictionary_encode(null_encoding="encode").indices.to_numpy()


def _nearest(top_n: int, id_column: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(id, keyword, cosine) from a group's terms and the vectors that it asked for.

    Of each document those rows are kept that may be among the ``top_n`` when cosines are
    rounded to six places.
    """

    def nearest(tf: pa.Table, replies: pa.Table) -> pa.Table:
        place = pc.index_in(tf["term"].combine_chunks(), replies["asked_term"].combine_chunks())
        tf, place = tf.filter(place.is_valid()), place.drop_null().to_numpy()
        ids, terms = tf[id_column].combine_chunks(), tf["term"].combine_chunks()
        order = np.argsort(doc_numbers(ids), kind="stable")
        doc = doc_numbers(ids.take(pa.array(order)))
        known = _widened(replies["vector"].combine_chunks())
        bits = replies["bits"].to_numpy().astype(np.int64)
        place, count = place[order], tf["tf"].to_numpy()[order]
        out: list[pa.Table] = []
        # Whole documents, some thousand rows at a time.
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        near = np.searchsorted(starts, np.arange(0, len(doc), ROWS_AT_ONCE), "right") - 1
        cuts = np.unique(np.append(starts[near], len(doc)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            kept, cosine = scored(known[place[a:b]], count[a:b] * bits[place[a:b]], doc[a:b])
            at = pa.array(order[a:b][kept])
            columns = [ids.take(at), terms.take(at), pa.array(cosine)]
            out.append(pa.Table.from_arrays(columns, ["id", "keyword", "cosine"]))
        empty = [ids.slice(0, 0), terms.slice(0, 0), pa.array([], pa.float64())]
        return pa.concat_tables([pa.Table.from_arrays(empty, ["id", "keyword", "cosine"]), *out])

    def scored(
        vectors: np.ndarray, weight: np.ndarray, doc: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        opens = np.diff(doc, prepend=-1) != 0
        starts, rank = np.flatnonzero(opens), np.cumsum(opens) - 1
        sums = np.add.reduceat(vectors * weight[:, None], starts, axis=0)
        squares = np.zeros(len(starts))
        for i in range(DIMENSIONS):
            squares += sums[:, i].astype(float) ** 2
        lengths = np.sqrt((vectors * vectors).sum(axis=1).astype(float)) * np.sqrt(squares)[rank]
        dots = (vectors * sums[rank]).sum(axis=1).astype(float)
        cosine = np.divide(dots, lengths, out=np.zeros(len(dots)), where=lengths != 0)
        by_cosine = np.lexsort((-cosine, rank))
        # The cosine of a document's last place; that of its last row where it has fewer.
        ends = np.append(starts[1:], len(rank))
        least = cosine[by_cosine[np.minimum(starts + top_n, ends) - 1]] - 2e-6
        kept = np.flatnonzero(cosine >= least[rank])
        return kept, cosine[kept]

    return nearest


def vector_keywords(
    docs: DataFrame,
    top_n: int = 5,
    id_column: str = "patent_id",
    text_column: str = "summary_text",
    window: int = 2,
    min_docs: int = 2,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """(id, rank, keyword, score): the words nearest to their document by cosine.

    A document is the sum of its words' vectors, each weighed by its count and by the bits of
    ``documents div documents with the word``. Words of fewer than ``min_docs`` documents are
    no keywords and have no weight: their contexts are those of the document itself. Vectors
    are learnt from ``docs``; a null text has no words, and rows of one id are one document.
    Documents are dealt to groups, and a group asks for the vector of a word once. The vectors
    of frequent words are broadcast and others joined, so that no word fills a task.
    """
    total = docs.count()
    words = docs.select(id_column, kept_words(F.col(text_column), stop_words).alias("words"))
    tf, asked = grouped_terms(words, id_column, total)
    frequency = asked.groupBy("term").agg(F.sum("n").alias("doc_freq"))
    vectors = (
        packed_vectors(docs, text_column, window, stop_words)
        .join(frequency.where(F.col("doc_freq") >= min_docs), "term")
        .withColumn("bits", F.length(F.bin(F.call_function("div", F.lit(total), F.col("doc_freq")))))
    )
    replies = frequency_lookup(asked, vectors, "term", "doc_freq", ["vector", "bits"]).select(
        F.col("part").alias("to_part"), F.col("term").alias("asked_term"), "vector", "bits"
    )
    kind = docs.schema[id_column].dataType.simpleString()
    terms = (
        tf.groupBy("part")
        .cogroup(replies.groupBy("to_part"))
        .applyInArrow(
            _nearest(top_n, id_column), f"id {kind}, keyword string, cosine double"
        )
    )
    scored = terms.select(
        F.col("id").alias(id_column), "keyword", F.round("cosine", 6).alias("score")
    )
    return top_k_per_group(scored, id_column, [F.desc("score"), F.asc("keyword")], top_n).select(
        id_column, "rank", "keyword", "score"
    )
