"""Keyword extraction: term weights, embeddings and lemmas."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.functions.text import (
    IRREGULAR_LEMMAS,
    NO_PLURALS,
    STOP_WORDS,
    singular_forms,
    tokens,
    without_stop_words,
)
from patentloom.operators.joins import frequency_lookup
from patentloom.operators.ranking import top_k_per_group
from patentloom.session import ship_package

# Letters, digits and underscores, two at least.
WORD = r"(?U)\w\w+"

# Documents encoded together; bounds the vectors held at a time.
ENCODED_AT_ONCE = 64

# Documents whose terms are looked up together; bounds the rows of one group.
DOCUMENTS_PER_GROUP = 1_000

# Rows of a batch of counts.
COUNTS_AT_ONCE = 100_000


def term_frequencies(
    docs: DataFrame, id_column: str = "patent_id", text_column: str = "summary_text",
    stop_words: list[str] = STOP_WORDS,
) -> DataFrame:
    """(id, term, tf) without stop words; a document is combined before the shuffle."""
    words = docs.select(id_column, F.explode(tokens(F.col(text_column))).alias("term"))
    return (
        words.where(~F.col("term").isin(stop_words))
        .groupBy(id_column, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def tfidf_keywords(
    docs: DataFrame,
    top_n: int = 20,
    id_column: str = "patent_id",
    text_column: str = "summary_text",
) -> DataFrame:
    """The ``top_n`` terms per document by tf * ln((N + 1) / (df + 1)), ties by term.

    Documents are dealt to groups once, their words counted before that. A group asks for the
    document frequency of each of its terms once, however many of its documents hold the
    term, and a term is asked for once per group, so that common terms fill no task. Only
    candidates leave a group.
    """
    total = docs.count()
    words = without_stop_words(tokens(F.coalesce(F.col(text_column), F.lit(""))))
    kind = docs.schema[id_column].dataType.simpleString()
    tf, asked = grouped_terms(docs.select(id_column, words.alias("words")), id_column, total)
    df = asked.groupBy("term").agg(F.sum("n").alias("doc_freq"))
    replies = asked.join(df, "term").select(
        F.col("part").alias("to_part"), F.col("term").alias("asked_term"), "doc_freq"
    )
    candidates = (
        tf.groupBy("part")
        .cogroup(replies.groupBy("to_part"))
        .applyInArrow(
            _candidates(top_n, total, id_column),
            f"{id_column} {kind}, term string, tf bigint, doc_freq bigint",
        )
    )
    score = F.col("tf") * F.log((F.lit(total) + 1) / (F.col("doc_freq") + 1))
    scored = candidates.withColumn("score", F.round(score, 9))
    return top_k_per_group(scored, id_column, [F.desc("score"), F.asc("term")], top_n).select(
        id_column, "rank", F.col("term").alias("keyword"), "tf", "doc_freq", "score"
    )


def grouped_terms(docs: DataFrame, id_column: str, total: int) -> tuple[DataFrame, DataFrame]:
    """(part, id, term, tf) of documents and arrays ``words``, dealt to groups by their ids,
    and (part, term, n): each group's terms with the number of its documents that hold them.

    Rows of one id are one document. All uses of the terms take the same columns and filters
    (no term is null, every ``n`` is above 0), so that their shuffle is computed once.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    groups = max(1, -(-total // DOCUMENTS_PER_GROUP))
    counted = (
        docs.mapInArrow(_counted, f"{id_column} {kind}, term string, count bigint")
        .where(F.col("term").isNotNull())
        .withColumn("part", F.pmod(F.hash(id_column), F.lit(groups)))
        .repartition("part")
    )
    tf = counted.groupBy("part", id_column, "term").agg(F.sum("count").alias("tf"))
    asked = tf.groupBy("part", "term").agg(F.count_if(F.col("tf") > 0).alias("n"))
    return tf, asked.where(F.col("n") > 0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, term, count) per row from ids and arrays of words."""
    for batch in batches:
        ids, words = batch.columns
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        size = max(1, len(coded.dictionary))
        row = np.repeat(np.arange(len(lengths)), lengths)
        found, n = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
        for at in range(0, len(found), COUNTS_AT_ONCE):
            row, term = np.divmod(found[at : at + COUNTS_AT_ONCE], size)
            taken = [ids.take(pa.array(row)), coded.dictionary.take(pa.array(term))]
            counts = pa.array(n[at : at + COUNTS_AT_ONCE].astype(np.int64))
            names = [batch.schema.names[0], "term", "count"]
            yield pa.RecordBatch.from_arrays([*taken, counts], names)


def _candidates(
    top_n: int, total: int, id_column: str
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Rows that may be among the ``top_n`` of their document once scores are rounded."""

    def candidates(tf: pa.Table, replies: pa.Table) -> pa.Table:
        place = pc.index_in(tf["term"].combine_chunks(), replies["asked_term"].combine_chunks())
        doc_freq = replies["doc_freq"].combine_chunks().take(place)
        table = tf.select([id_column, "term", "tf"]).append_column("doc_freq", doc_freq)
        if not table.num_rows:
            return table
        ids = table[id_column].combine_chunks().dictionary_encode(null_encoding="encode")
        doc = ids.indices.to_numpy()
        score = table["tf"].to_numpy() * np.log((total + 1) / (doc_freq.to_numpy() + 1))
        order = np.lexsort((-score, doc))
        starts = np.flatnonzero(np.diff(doc[order], prepend=-1))
        ends = np.append(starts[1:], len(doc))
        least = score[order[np.minimum(starts + top_n, ends) - 1]]
        least = least - 1e-8 - 1e-12 * np.abs(least)
        # Documents stand in the order of their numbers, and every number occurs.
        return table.take(pa.array(np.flatnonzero(score >= least[doc])))

    return candidates


def keyword_lists(ranked: DataFrame, id_column: str = "patent_id") -> DataFrame:
    """(id, keywords array<struct<_1, _2>>) from ranked (keyword, score) rows."""
    entry = F.struct("rank", F.struct(F.col("keyword").alias("_1"), F.col("score").alias("_2")))
    ordered = F.sort_array(F.collect_list(entry))
    return ranked.groupBy(id_column).agg(
        F.transform(ordered, lambda x: x["col2"]).alias("keywords")
    )


def embedding_keywords(
    docs: DataFrame,
    make_embedder: Callable[[], object],
    top_n: int = 5,
    id_column: str = "patent_id",
    text_column: str = "summary_text",
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """The ``top_n`` words per document closest to the document by cosine.

    ``make_embedder`` builds an object with ``encode(texts) -> matrix`` (the interface
    of sentence-embedding models) once per task. Documents stay where they are read:
    there is no shuffle. Words and stop words are handled before Python, which only calls
    the model; words shared by documents encoded together are encoded once.
    """
    ship_package(docs.sparkSession)
    words = F.regexp_extract_all(
        F.lower(F.coalesce(F.col(text_column), F.lit(""))), F.lit(WORD), F.lit(0)
    )
    prepared = docs.select(
        id_column, without_stop_words(words, list(stop_words)).alias("_words")
    )

    def best_words(kept: Sequence[Sequence[str]], embedder) -> Iterator[list[dict]]:
        kept = [list(words) for words in kept]
        vocabulary = sorted(set().union(*kept))
        if not vocabulary:
            yield from ([] for _ in kept)
            return
        place = {w: i for i, w in enumerate(vocabulary)}
        vectors = np.asarray(embedder.encode(vocabulary))
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        doc_vectors = iter(np.asarray(embedder.encode([" ".join(k) for k in kept if k])))
        for words in kept:
            if not words:
                yield []
                continue
            doc = next(doc_vectors)
            rows = np.array(sorted({place[w] for w in words}), dtype=np.int64)
            norms = lengths[rows] * np.sqrt((doc * doc).sum())
            scores = np.divide(
                vectors[rows] @ doc, norms, out=np.zeros(len(rows)), where=norms != 0
            )
            best = np.argsort(-scores, kind="stable")[:top_n]
            yield [
                {"_1": vocabulary[rows[i]], "_2": round(float(scores[i]), 4)} for i in best
            ]

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = make_embedder()
        for batch in batches:
            for start in range(0, len(batch), ENCODED_AT_ONCE):
                part = batch.iloc[start : start + ENCODED_AT_ONCE]
                yield pd.DataFrame(
                    {
                        id_column: part[id_column],
                        "keywords": list(best_words(part["_words"], embedder)),
                    }
                )

    return prepared.mapInPandas(
        rank, f"{id_column} string, keywords array<struct<_1: string, _2: double>>"
    )


def keyword_table(
    docs: DataFrame, top_n: int = 20, id_column: str = "patent_id",
    text_column: str = "summary_text",
) -> DataFrame:
    """(id, keywords) by tf-idf: what the keyword reports take."""
    return keyword_lists(tfidf_keywords(docs, top_n, id_column, text_column), id_column)


def corpus_lemmas(terms: DataFrame, column: str = "term") -> DataFrame:
    """(word, lemma) for plurals whose singular is a term of the corpus too.

    An ending is taken off only where the shorter word occurs, so words that merely end like
    a plural stay as they are; words that never are plurals, and irregular ones, come from
    tables. Of several singulars that occur, the first by rule counts.
    """
    words = terms.select(F.col(column).alias("word")).where(F.col("word").isNotNull()).distinct()
    options = words.where(~F.col("word").isin(NO_PLURALS)).select(
        "word", F.posexplode(singular_forms(F.col("word"))).alias("rule", "lemma")
    )
    known = words.select(F.col("word").alias("lemma"))
    return (
        options.join(known, "lemma")
        .groupBy("word")
        .agg(F.min(F.struct("rule", "lemma")).alias("best"))
        .select("word", F.col("best.lemma").alias("lemma"))
    )


def lemmatized(
    keywords: DataFrame, column: str = "keyword", lemmas: DataFrame | None = None
) -> DataFrame:
    """``normalized_keyword`` next to ``column``, blank results dropped.

    Lemmas come from ``lemmas`` (word, lemma) where a word is in it, then from the table of
    irregular plurals, then from the corpus itself: the distinct values of ``column``. Words
    that ``lemmas`` repeats take their least lemma.
    """
    counts = keywords.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_n")
    )
    found = corpus_lemmas(counts, column).select(F.col("word").alias(column), "lemma")
    irregular = F.create_map(*(F.lit(x) for pair in IRREGULAR_LEMMAS.items() for x in pair))
    best = F.coalesce(F.try_element_at(irregular, F.col(column)), "lemma", column)
    table = counts.join(found, column, "left")
    if lemmas is not None:
        given = lemmas.groupBy(F.col("word").alias(column)).agg(F.min("lemma").alias("_given"))
        table = table.join(given, column, "left")
        best = F.coalesce("_given", best)
    table = table.select(column, "_n", best.alias("normalized_keyword"))
    out = frequency_lookup(keywords, table, column, "_n", ["normalized_keyword"])
    return out.where(F.trim("normalized_keyword") != "")


def words_of(docs: DataFrame, text_column: str = "summary_text") -> DataFrame:
    """Token arrays before and after stop-word removal."""
    words = tokens(F.col(text_column))
    return docs.withColumn("words", words).withColumn(
        "filtered_words", without_stop_words(F.col("words"))
    )
