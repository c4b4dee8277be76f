"""Benchmark decontamination against brute force."""

import random
import re

import pytest

from patentloom.llm.benchmark_scan import scan

DOCS = "doc_id long, text string, items string, n_hit int, item_id long"
ITEMS = "item_id long, text string, spans string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    out = []
    for doc, text, *_ in docs:
        own, hit, found = words(text), set(), set()
        for item, other, *_ in items:
            theirs = words(other)
            size = min(window, len(theirs))
            for i in range(len(theirs) - size + 1) if theirs else ():
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == theirs[i : i + size]:
                        hit.update(range(j, j + size))
                        if item is not None:
                            found.add(str(item))
        out.append((doc, text, len(own), len(hit), sorted(found), bool(hit)))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_matches_brute_force(spark, shard_bytes):
    rng = random.Random(shard_bytes)
    letters = ["a", "B", "7", "é", "日本", "ab", "Ab", "x"]
    seps = [" ", "-", "\n", "_", "\x00"]

    def text(n):
        return "".join(rng.choice(letters) + rng.choice(seps) for _ in range(n))

    items = [(i, text(rng.randrange(8)), "s") for i in range(6)]
    items += [(6, None, ""), (7, " .. ", ""), (None, "zz zz", ""), (0, "b b b", ""), (0, "b b b", "")]
    docs = [(i, text(rng.randrange(60)), "x", 5, 9) for i in range(40)]
    docs += [(50, None, "", 0, 0), (51, "", "", 0, 0), (None, "zz zz", "", 0, 0), (1, "a zz zz", "", 0, 0)]
    docs += [(60, "q " * 50_000 + "zz ZZ", "", 0, 0)]
    out = scan(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), window=3,
        shard_bytes=shard_bytes,
    )
    assert out.columns == [
        "doc_id", "text", "item_id", "n_words", "n_hit", "items", "spans", "contaminated"
    ]
    got = out.collect()
    key = repr
    assert sorted(
        [(r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got],
        key=key,
    ) == sorted(brute(docs, items, 3), key=key)
    for r in got:
        raw = (r["text"] or "").encode()
        spans = [raw[s["start"] : s["end"]].decode() for s in r["spans"]]
        assert sum(len(words(s)) for s in spans) == r["n_hit"]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert scan(docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b", "", 0, 0)], DOCS)
    assert [r["contaminated"] for r in scan(one, items).collect()] == [False]


def test_another_benchmark_of_the_same_texts_keeps_its_ids(spark):
    docs = spark.createDataFrame([(1, "one two three", "", 0, 0)], DOCS).coalesce(1)
    for ids in (["1"], ["2", "3"]):
        items = spark.createDataFrame([(int(i), "one two", "") for i in ids], ITEMS)
        assert scan(docs, items).first()["items"] == ids
