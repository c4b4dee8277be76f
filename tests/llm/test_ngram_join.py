"""N-gram Jaccard join against brute force."""

import random
import re

import pytest

from patentloom.llm.ngram_join import Settings, link_documents

SCHEMA = "doc_id long, text string, n int, bits string, bucket long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=80):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}
    links = [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, t in sets[:x]
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            for c in (a, b):
                changed |= least[c] != low
                least[c] = low
    return sorted(
        [(i, len(shingles(t)), least.get(i)) for i, t in rows], key=lambda r: (r[0] is None, r)
    )


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "A", "a", "日本"]
    passage = [rng.choice(words) for _ in range(60)]
    texts = [None, "", " \n", "a", "A", "b a", "a a a a a a a a a", "x" * 5000]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 90))]
        if rng.random() < 0.3:
            base += passage
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            near = list(base)
            for _ in range(rng.randrange(5)):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(("\n" if rng.random() < 0.5 else " ").join(near))
    texts += rng.sample(texts, 10)
    ids = list(range(-3, len(texts) - 3))
    rng.shuffle(ids)
    return [*zip(ids, texts, strict=True), (None, "b a"), (None, None)]


SMALL = {"bits": 64, "fan": 2, "bucket_bytes": 2_000}


@pytest.mark.parametrize(
    "settings",
    [
        Settings(),
        Settings(**SMALL, group=4, orders=1),
        Settings(**SMALL, group=3, orders=0),
        Settings(percent=50, bits=256, fan=3),
    ],
)
def test_matches_brute_force(spark, settings):
    rows = corpus(settings.group + settings.percent)
    docs = spark.createDataFrame([(*r, 1, "b", 2) for r in rows], SCHEMA)
    got = sorted(
        map(tuple, link_documents(docs, settings=settings).collect()),
        key=lambda r: (r[0] is None, r),
    )
    assert got == brute(rows, settings.percent)


def test_empty_table_and_repeated_rows(spark):
    assert link_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(4, "a b c", 1, "", 1), (4, "a b c", 2, "", 1), (2, "A B C", 1, "", 1)]
    got = link_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(2, 1, 2), (4, 1, 2), (4, 1, 2)]


@pytest.mark.parametrize("settings", [Settings(), Settings(**SMALL, group=3, orders=0), Settings(**SMALL, group=3, orders=1)])
def test_one_id_with_several_texts_is_one_node(spark, settings):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(8):
        one, other = ([rng.choice(words) for _ in range(80)] for _ in range(2))
        near_one, near_other = [*one[:-1], "x"], ["y", *other[1:]]
        rows += [(10 * k + i, " ".join(t)) for i, t in ((5, one), (5, other), (6, near_one), (7, near_other))]
    shared = [rng.choice(words) for _ in range(100)]
    rows += [(900, " ".join(shared)), (900, " ".join([*shared[:-1], "z"])), (901, " ".join(["v", *shared[1:-1], "z"]))]
    docs = spark.createDataFrame([(*r, 1, "b", 2) for r in rows], SCHEMA)
    got = sorted(map(tuple, link_documents(docs, settings=settings).collect()))
    assert got == brute(rows)
    assert {c for i, _, c in got if i < 900} == {10 * k + 5 for k in range(8)}


def test_long_words_that_only_look_alike_link_nothing(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, word, 1, "", 1), (2, word.translate(str.maketrans("ab", "ba")), 1, "", 1)]
    got = sorted(map(tuple, link_documents(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [(1, 1, 1), (2, 1, 2)]
