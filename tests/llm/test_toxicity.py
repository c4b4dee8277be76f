"""Segments, training and scoring of toxic passages."""

import random

import pytest

from patentloom.llm import toxicity

SCHEMA = "doc_id long, text string, score string, words int"


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition."""
    def best(a, b):
        top = (0, None)
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > top[0] + 1e-12:
                    top = (total, (i, j + 1))
        if top[1] is None:
            return []
        i, j = top[1]
        return [*best(a, i), (i, j, top[0]), *best(j, b)]

    return best(0, len(scores))


def test_segments_match_their_definition():
    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.uniform(-2, 1.5) for _ in range(rng.randrange(25))]
        got = toxicity.maximal_segments(np.array(scores))
        want = brute_segments(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def corpus(rng, n):
    plain = ["".join(rng.choice("abdefgh") for _ in range(5)) for _ in range(200)]
    bad = ["vileword", "nastyone", "grimterm"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", ","]))
        rows.append((i, " ".join(words), "x", 1))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(8)
    rows, labels = corpus(rng, 900)
    odd = [(None, "vileword " * 30, "x", 1), (5000, None, "x", 1), (5001, "", "x", 1),
           (5002, "vileword nastyone grimterm " * 40_000, "x", 1), (1, rows[1][1], "x", 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    known = spark.createDataFrame(
        [*labels[:600], (None, 1), (3, None), (1, 0)], "doc_id long, toxic int"
    )
    model = toxicity.train(docs, known)
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "words", *toxicity.RESULTS]
    got = out.collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    held = [(by_id[i]["predicted"], y) for i, y in labels[600:]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    least = min(r["score"] for r in got)
    assert by_id[5000]["score"] == by_id[5001]["score"] == least
    assert by_id[None]["predicted"] == by_id[5002]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 for r in got)
    row = next(r for r in got if r["passages"] and r["doc_id"] == 0)
    found = [row["text"].encode()[p["start"] : p["end"]].decode() for p in row["passages"]]
    assert any(w in f for f in found for w in ("vileword", "nastyone", "grimterm"))


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "a b", "", 1)], SCHEMA)
    assert [r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()] == [0]
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.train(empty, none)).collect() == []


def test_training_sums_all_passages_of_a_long_document(spark):
    import pyarrow as pa

    rng = random.Random(3)
    rows, labels = corpus(rng, 300)
    plain = [w for w in rows[1][1].split() if "vile" not in w]
    passages = " ".join(" ".join(["vileword nastyone grimterm", *(rng.choice(plain) for _ in range(40))]) for _ in range(120))
    rows.append((900, passages, "x", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.train(docs, spark.createDataFrame([*labels, (900, 1)], "doc_id long, toxic int"))
    row = toxicity.score(docs.where("doc_id = 900"), model).first()
    assert len(row["passages"]) > 50

    class Sent:
        value = model

    batch = pa.RecordBatch.from_pylist([{"text": passages, "toxic": 1}])
    batch = batch.set_column(1, "toxic", batch.column(1).cast(pa.int32()))
    (out,) = toxicity._evidence(Sent, toxicity.Settings())(iter([batch]))
    total = out.column(1)[0].as_py()
    z = model.intercept + model.slope * float(toxicity._damped(total))
    import math

    assert row["score"] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6)


def test_memory_of_a_large_batch():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 5000, 400)) for _ in range(8000)]
    texts[5:7] = [None, ""]
    batch = pa.record_batch([pa.array(texts), pa.array([int(i % 4 == 0) for i in range(8000)], pa.int32())],
                            names=["text", "toxic"])
    settings = toxicity.Settings()
    sizes = [part.num_rows for part in toxicity._slices(batch, "text")]
    assert sum(sizes) == 8000
    assert len(list(toxicity._counter(settings)([batch.slice(0, 500)]))) == 2  # fills the powers
    tracemalloc.start()
    parts = list(toxicity._counter(settings)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 18 MB of texts: the tables take 20 MB and their sum 8 MB.
    assert peak < 48 << 20, peak >> 20
    # Words are counted on the side of their document's label.
    toxic, other = (sum(p.column(c).to_numpy().sum() for p in parts if p.column(0)[0].as_py() == 0)
                    for c in (2, 3))
    assert (toxic, other) == (2000 * 400, 5998 * 400)
