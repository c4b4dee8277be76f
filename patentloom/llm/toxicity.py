"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts words, and their first bytes, in toxic and other documents. Each gets the
log-odds of its toxic share, shrunk by a Dirichlet prior towards the overall share; words
seen too rarely take the log-odds of their beginning, so unseen endings are covered. Less a
drift, these scores are negative on ordinary text, and the maximal scoring segments of a
document, found in linear time, are its candidate passages. Scores of such segments follow
an extreme-value law under ordinary text (expected number ``K n exp(-lambda S)``); lambda
comes from the scores of ordinary words, K from the best segments of ordinary documents.
A document's evidence is the sum over its significant passages; a logistic curve over it,
fitted on the same rows, gives the score.

The model is two tables of fixed size and a few numbers, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.llm.arrays import (
    U64, Texts, mix, prefix_hashes, range_hashes, releasing, words_of,
)
from patentloom.session import ship_package

RESULTS = ("score", "predicted", "evidence", "passages")
PASSAGE = "array<struct<start:int,end:int,score:double,p_value:double>>"


@dataclass(frozen=True)
class Settings:
    """``max_labels``: bound of the training sample (rows with the least hash of their id).

    ``word_bits`` and ``head_bits``: sizes of the hashed tables of words and of their first
    ``head`` bytes; ``rare``: words seen less often take the score of their beginning;
    ``prior``: pseudo-counts; ``drift``: taken from every score; ``level``: expected number
    of passages of this score in ordinary text up to which a passage is significant;
    ``threshold``: score from which a document is predicted to be toxic.
    """

    max_labels: int = 200_000
    word_bits: int = 20
    head_bits: int = 18
    head: int = 5
    rare: int = 20
    prior: float = 5.0
    drift: float = 2.0
    level: float = 1.0
    threshold: float = 0.7


@dataclass
class Model:
    words: np.ndarray  # float32, NaN where the word is rare
    heads: np.ndarray  # float32
    scale: float = 1.0  # lambda
    k: float = 1.0
    intercept: float = -20.0
    slope: float = 0.0


def _columns(texts: pa.Array) -> Texts:
    """Texts in their own order."""
    binary = texts.cast(pa.binary()).fill_null(b"").cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    n = len(binary)
    offsets = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + n + 1] if n else (
        np.zeros(1, np.int64)
    )
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(np.zeros(n, np.int64), raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def _features(texts: Texts, settings: Settings):
    """Words with table indexes of the words and of their beginnings."""
    words = words_of(texts, lower=True)
    lowered = texts.data.astype(U64)
    lowered[(texts.data >= 65) & (texts.data <= 90)] += U64(32)
    head_end = np.minimum(words.start + settings.head, words.end)
    heads = mix(range_hashes(prefix_hashes(lowered + U64(1)), words.start, head_end))
    word_at = (words.hash >> U64(64 - settings.word_bits)).astype(np.int64)
    return words, word_at, (heads >> U64(64 - settings.head_bits)).astype(np.int64)


def _slices(batch: pa.RecordBatch, text: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text: memory follows the longest text."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    lengths = pc.binary_length(column).fill_null(0).to_numpy()
    group = np.cumsum(lengths, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _counter(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m = 1 << settings.word_bits, 1 << settings.head_bits
        totals = [np.zeros((2, n), np.int64), np.zeros((2, m), np.int64)]
        for batch in batches:
            for part in _slices(batch, "text"):
                words, *at = _features(_columns(part.column(0)), settings)
                toxic = part.column(1).to_numpy(zero_copy_only=False) > 0
                of = np.repeat(toxic, np.diff(words.first)).astype(np.int64)
                for total, where in zip(totals, at, strict=True):
                    np.add.at(total.reshape(-1), of * total.shape[1] + where, 1)
        for kind, total in enumerate(totals):
            seen = np.flatnonzero(total.sum(0))
            for a in range(0, len(seen), 100_000):
                s = seen[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), kind, np.int32)), pa.array(s),
                     pa.array(total[1][s]), pa.array(total[0][s])],
                    names=["kind", "at", "toxic", "other"],
                )

    return run


def _log_odds(toxic: np.ndarray, other: np.ndarray, base: float, prior: float) -> np.ndarray:
    share = (toxic + prior * base) / (toxic + other + prior)
    return np.log(share / (1 - share)) - math.log(base / (1 - base))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, in linear time.

    Kept segments form a list of disjoint ones; a new run of positive scores joins with the
    nearest kept one that begins lower, if it ends higher than that.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.append(0.0, np.cumsum(scores, dtype=np.float64))
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts = positive[np.append(0, breaks + 1)]
    ends = positive[np.append(breaks, len(positive) - 1)] + 1
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, low, high, lower one
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        low, high = float(total[start]), float(total[end])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((start, end, low, high, j))
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def _scores(texts: Texts, model: Model, settings: Settings):
    words, word_at, head_at = _features(texts, settings)
    own = model.words[word_at]
    return words, np.where(np.isnan(own), model.heads[head_at], own) - settings.drift


BINS, LOW, HIGH = 2000, -10.0, 10.0


def _fitter(sent, settings: Settings):
    """Per training document its best segment, and the scores of ordinary words by bin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(BINS, np.int64)
        for batch in batches:
            for part in _slices(batch, "text"):
                words, scores = _scores(_columns(part.column(0)), sent.value, settings)
                toxic = part.column(1).to_numpy(zero_copy_only=False) > 0
                ordinary = scores[~np.repeat(toxic, np.diff(words.first))]
                place = ((ordinary - LOW) / (HIGH - LOW) * BINS).astype(np.int64)
                bins += np.bincount(np.clip(place, 0, BINS - 1), minlength=BINS)
                rows = []
                for i, (a, b) in enumerate(zip(words.first, words.first[1:], strict=False)):
                    best = max((s for *_, s in maximal_segments(scores[a:b])), default=0.0)
                    rows.append((-1, int(toxic[i]), int(b - a), float(best)))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(FIT.names, r, strict=True)) for r in rows], schema=FIT
                )
        seen = np.flatnonzero(bins)
        yield pa.RecordBatch.from_pylist(
            [{"bin": int(i), "toxic": 0, "n": int(bins[i]), "best": 0.0} for i in seen], schema=FIT
        )

    return run


FIT = pa.schema(
    [("bin", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64()), ("best", pa.float64())]
)


def _evidence(sent, settings: Settings):
    """Per training document its label and evidence, of all its segments as in scoring."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in _slices(batch, "text"):
                words, scores = _scores(_columns(part.column(0)), model, settings)
                toxic = part.column(1).to_numpy(zero_copy_only=False) > 0
                found = [
                    evidence(int(b - a), (s for *_, s in maximal_segments(scores[a:b])), model, settings.level)
                    for a, b in zip(words.first, words.first[1:], strict=False)
                ]
                columns = [pa.array(toxic.astype(np.int32)), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "evidence"])

    return run


def _scale(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of ``E exp(lambda s) = 1``; 1 where there is none."""
    weights = weights / weights.sum()
    if (values * weights).sum() >= 0 or not (values[weights > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    excess = lambda x: float((weights * np.exp(np.minimum(x * values, 700))).sum()) - 1
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def evidence(n: int, segments: Iterable[float], model: Model, level: float) -> float:
    """Sum of ``-ln E`` over segments expected at most ``level`` times in ``n`` words."""
    space = math.log(model.k * max(n, 1))
    gains = (model.scale * s - space for s in segments)
    return sum(g for g in gains if g >= -math.log(level))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    design = np.stack([np.ones_like(x), x], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        w = p * (1 - p) + 1e-9
        ridge = np.diag([1e-3, 1e-2])
        step = np.linalg.solve(
            (design * w[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ beta
        )
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _damped(evidence_: np.ndarray | float):
    return np.log1p(evidence_)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """A model from the labelled documents; null ids, texts and labels are left out.

    Of several labels of a document the greatest counts. Without a label of each kind the
    model calls every document harmless.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sample = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
        .dropna()
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(settings.max_labels)
    )
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).dropna()
    rows = rows.join(F.broadcast(sample), "id").select("text", "toxic")
    count = releasing(_counter(settings))
    counted = rows.mapInArrow(count, "kind int, at long, toxic long, other long")
    table = counted.groupBy("kind", "at").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    got = table.toArrow()
    kinds, at, t, o = (got[c].to_numpy() for c in ("kind", "at", "t", "o"))
    sizes = (1 << settings.word_bits, 1 << settings.head_bits)
    counts = []
    for kind, size in enumerate(sizes):
        own = kinds == kind
        pair = np.zeros((2, size))
        pair[0][at[own]], pair[1][at[own]] = t[own], o[own]
        counts.append(pair)
    toxic, other = counts[0].sum(1)
    if not toxic or not other:
        return Model(np.zeros(sizes[0], np.float32), np.zeros(sizes[1], np.float32))
    base = toxic / (toxic + other)
    tables = [_log_odds(*c, base, settings.prior).astype(np.float32) for c in counts]
    tables[0][counts[0].sum(0) < settings.rare] = np.nan
    model = Model(*tables)
    sent = spark.sparkContext.broadcast(model)
    fit = rows.mapInArrow(
        releasing(_fitter(sent, settings)), "bin int, toxic int, n long, best double"
    ).toArrow()
    place, toxic, n = (fit[c].to_numpy() for c in ("bin", "toxic", "n"))
    middle = LOW + (place[place >= 0] + 0.5) * (HIGH - LOW) / BINS
    model.scale = _scale(middle, n[place >= 0].astype(float))
    docs_at = np.flatnonzero(place < 0)
    toxic, n = toxic[docs_at], n[docs_at]
    tops = fit["best"].to_numpy()[docs_at][toxic == 0]
    model.k = float(1 / max(np.mean(n[toxic == 0] * np.exp(-model.scale * tops)), 1e-300))
    # Once more, now that it is known which segments count.
    sent = spark.sparkContext.broadcast(model)
    gather = releasing(_evidence(sent, settings))
    found = rows.mapInArrow(gather, "toxic int, evidence double").toArrow()
    toxic, gathered = (found[c].to_numpy() for c in ("toxic", "evidence"))
    model.intercept, model.slope = _logistic(_damped(gathered), toxic.astype(float))
    return model


def _scorer(sent, text: str, schema: pa.Schema, kept: list[str], settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in _slices(batch, text):
                texts = _columns(part.column(part.schema.get_field_index(text)))
                words, scores = _scores(texts, model, settings)
                out, passages = [], []
                for i, (a, b) in enumerate(zip(words.first, words.first[1:], strict=False)):
                    n = int(b - a)
                    found = [
                        (s, e, x, model.k * n * math.exp(-min(model.scale * x, 700)))
                        for s, e, x in maximal_segments(scores[a:b])
                    ]
                    found = [f for f in found if f[3] <= settings.level]
                    total = evidence(n, (f[2] for f in found), model, settings.level)
                    z = model.intercept + model.slope * float(_damped(total))
                    zero = texts.offsets[i]
                    out.append((1 / (1 + math.exp(-max(-700.0, min(z, 700.0)))), total))
                    passages.append([
                        {
                            "start": int(words.start[a + s] - zero),
                            "end": int(words.end[a + e - 1] - zero),
                            "score": x,
                            "p_value": -math.expm1(-e_value),
                        }
                        for s, e, x, e_value in found
                    ])
                score = [s for s, _ in out]
                new = {
                    "score": score,
                    "predicted": [int(s >= settings.threshold) for s in score],
                    "evidence": [e for _, e in out],
                    "passages": passages,
                }
                arrays = [
                    part.column(part.schema.get_field_index(c)).cast(schema.field(c).type)
                    for c in kept
                ]
                arrays += [pa.array(new[c], schema.field(c).type) for c in RESULTS]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def score(
    docs: DataFrame, model: Model, text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (0 or 1), evidence and passages.

    Passages have byte offsets in the text, a segment score and a p-value. Null and empty
    texts have no evidence and the least score. Every row stays, repeated ones too; columns
    with a result's name are replaced, all others stay as they are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c not in RESULTS or c == text]
    new = _parse_datatype_string(
        f"score double, predicted int, evidence double, passages {PASSAGE}"
    )
    plain = docs.select(*kept)
    schema = StructType([*plain.schema.fields, *new.fields])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return plain.mapInArrow(
        releasing(_scorer(sent, text, to_arrow_schema(schema), kept, settings)), schema
    )
