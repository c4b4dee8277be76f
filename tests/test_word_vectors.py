"""Word vectors against sums by hand, and what they say about documents."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np

from patentloom.operators import keywords
from patentloom.operators import word_vectors as wv

SCHEMA = "patent_id string, summary_text string, vector int, term string"


def index_vector(word):
    out = [0] * wv.DIMENSIONS
    for byte in hashlib.md5(word.encode()).digest()[: wv.NONZERO]:
        out[byte % wv.DIMENSIONS] += 1 if byte & wv.DIMENSIONS else -1
    return out


def brute_vectors(texts, window):
    sums = defaultdict(lambda: [0] * wv.DIMENSIONS)
    for text in texts:
        words = [w for w in (text or "").lower().split() if w not in wv.STOP_WORDS]
        for i, word in enumerate(words):
            for j in range(max(0, i - window), min(len(words), i + window + 1)):
                if j != i:
                    sums[word] = [a + b for a, b in zip(sums[word], index_vector(words[j]), strict=True)]
    out = {}
    for word, c in sums.items():
        most = max(1, *map(abs, c))
        out[word] = [int(math.copysign(abs(x) * wv.SCALE // most, x)) for x in c]
    return out


def sample():
    rng = random.Random(4)
    topics = [[f"{t}{k}" for k in range(8)] for t in ("cell", "wing", "Lens")]
    texts = []
    for i in range(60):
        words = rng.choices(topics[i % 3], k=rng.randrange(3, 30)) + ["the", "of"]
        rng.shuffle(words)
        texts.append(" ".join(words))
    return [*texts, None, "", "single", "the of and", "Ünï cell0 Ünï"]


def test_vectors_equal_sums_by_hand(spark):
    texts = sample()
    docs = spark.createDataFrame([(str(i), t, 1, "x") for i, t in enumerate(texts)], SCHEMA)
    for window in (1, 2, 3):
        got = {r.term: r.vector for r in wv.word_vectors(docs.repartition(4), window=window).collect()}
        assert got == brute_vectors(texts, window)
    assert wv.word_vectors(docs.limit(0)).collect() == []


def test_keywords_are_nearest_to_their_document(spark):
    texts = sample()
    docs = spark.createDataFrame([(str(i), t, 1, "x") for i, t in enumerate(texts)], SCHEMA)
    got = defaultdict(list)
    for r in wv.vector_keywords(docs, top_n=3).orderBy("patent_id", "rank").collect():
        got[r.patent_id].append((r.keyword, r.score))
    vectors, tf = brute_vectors(texts, 2), {}
    df = Counter()
    for i, text in enumerate(texts):
        tf[str(i)] = Counter(w for w in (text or "").lower().split() if w not in wv.STOP_WORDS)
        df.update(tf[str(i)].keys())
    for i, counts in tf.items():
        weights = {
            w: n * (len(texts) // df[w]).bit_length() for w, n in counts.items() if df[w] > 1 and w in vectors
        }
        doc = [sum(n * vectors[w][k] for w, n in weights.items()) for k in range(wv.DIMENSIONS)]

        def cosine(w, doc=doc):
            v = vectors[w]
            length = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in doc))
            return round(sum(x * y for x, y in zip(v, doc, strict=True)) / length, 6) if length else 0.0

        want = sorted(((-cosine(w), w) for w in weights))[:3]
        assert got.get(i, []) == [(w, -s) for s, w in want]
    # Documents of one topic get words of that topic.
    assert all(w.startswith(("cell", "wing", "lens")[int(i) % 3]) for i in map(str, range(60)) for w, _ in got[i])


def test_frequent_words_are_combined_and_looked_up(spark, plan_of):
    docs = spark.createDataFrame([("1", "a1 b1 a1", 1, "x"), ("2", "a1 c1", 1, "x")], SCHEMA)
    plan = plan_of(wv.vector_keywords(docs))
    assert "BroadcastHashJoin" in plan
    assert "Python" not in plan and "NestedLoop" not in plan


def largest_method(df):
    """Bytes of the largest generated method; the JVM compiles none above 8,000."""
    df.collect()
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    docs = spark.createDataFrame([(str(i), t, 1, "x") for i, t in enumerate(sample())], SCHEMA)
    assert largest_method(wv.word_vectors(docs)) < 8000
    assert largest_method(wv.vector_keywords(docs)) < 8000


def test_batches_and_widths_change_nothing(spark):
    rng = random.Random(5)
    # A sum above 127 and one above 32,767, so that stored sums differ in width.
    texts = [*sample(), "far near " * 20_000, "mid few " * 100, " ".join(rng.choices("abcdefgh", k=500))]
    docs = spark.createDataFrame(
        [(str(i % 40), t, 1, "x") for i, t in enumerate(texts)] + [(None, texts[0], 1, "x")], SCHEMA
    ).coalesce(2)
    want = brute_vectors([*texts, texts[0]], 2)
    keywords = sorted(map(tuple, wv.vector_keywords(docs).collect()), key=repr)
    # A document with the null id is one too, and equal ids are one document.
    assert {i for i, *_ in keywords} >= {None, "0"} and max(r for _, r, *_ in keywords) == 5
    assert {r.term: r.vector for r in wv.word_vectors(docs).collect()} == want
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert {r.term: r.vector for r in wv.word_vectors(docs).collect()} == want
        assert sorted(map(tuple, wv.vector_keywords(docs).collect()), key=repr) == keywords
    finally:
        spark.conf.set(key, before)


def test_slices_are_whole_texts():
    lengths = np.array([0, 5, wv.WORDS_AT_ONCE - 5, 1, 3 * wv.WORDS_AT_ONCE, 0, 7])
    found = list(wv._slices(lengths))
    assert found == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(wv._slices(np.array([], int))) == []


def test_groups_of_documents_change_nothing(spark, monkeypatch, plan_of):
    docs = spark.createDataFrame([(str(i), t, 1, "x") for i, t in enumerate(sample())], SCHEMA)
    whole = wv.vector_keywords(docs)
    # A document's rows go to its group, never to a word.
    assert "FlatMapCoGroupsInArrow [part" in plan_of(whole)
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(keywords, "DOCUMENTS_PER_GROUP", 7)
    assert sorted(map(tuple, wv.vector_keywords(docs.repartition(3)).collect())) == want
    assert wv.vector_keywords(docs.limit(0)).collect() == []
