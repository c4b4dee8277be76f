"""Phrases against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from patentloom.llm import phrase_mining

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, bucket string"


def brute(rows, longest=4, least=30, share=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            around = [
                b for q, b in found.items() if len(q) > len(p)
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= share * a for b in around):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = phrase_mining.mine_phrases(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(rng, n):
    words = ["the", "THE", "of", "new", "york", "naïve", "日本", "a'b", "x1", "big", "new"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "\n", "!"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "fr", None]), "p", 1, "b"))
    return rows


def test_phrases_with_odd_rows(spark):
    rng = random.Random(2)
    rows = corpus(rng, 150)
    rows += [(500, None, "en", "p", 1, "b"), (501, "", "", "p", 1, "b"), (None, "new york", "und", "p", 1, "b")]
    rows += [(7, "repeated rows of one hot text. " * 3, "en", None, None, None)] * 40
    rows += [(8, "tie one two. ", "fr", "p", 1, "b"), (9, "\x0b \x00 \x1c", "fr", "p", 1, "b")] * 40
    rows += [(10, "long " * 60_000 + "text ", "en", "p", 1, "b")]
    want = brute(rows, least=20)
    assert {w[0] for w in want} == {"en", "fr", "und"}
    assert mined(spark, rows, least=20) == want
    # Many small buckets, and none between texts.
    assert mined(spark, rows, least=20, bucket_bytes=200) == want
    assert mined(spark, rows, parts=1, least=12, top=9, longest=3, share=60) == brute(
        rows, least=12, top=9, longest=3, share=60
    )


def test_without_documents_or_phrases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None, "p", 1, "b")]) == []
    assert mined(spark, [(1, "one two. three", "en", "p", 1, "b")] * 10) == []
    with pytest.raises(ValueError):
        mined(spark, [], longest=1)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 1 << 62
    df = spark.createDataFrame(
        [(["a", "b"], big, [big + 1, big], [big + 3, big])], "words array<string>, a long, heads array<long>, tails array<long>"
    )
    row = phrase_mining._with_cut(df).first()
    assert (row["score"], row["l"], row["r"]) == (2_000_000 * big // (2 * big + 4), big + 1, big + 3)


def test_wide_numbers_and_counts_travel_unchanged():
    relation = [
        {
            "bucket": 5,
            "groups": phrase_mining._squeezed(np.array([0, 1] * 400 + [-1, 1, 0], np.int32)),
            "breaks": None,
            "ids": phrase_mining._squeezed(np.array([1 << 40, 3], np.int64)),
        }
    ]
    batch = pa.RecordBatch.from_pylist(relation, schema=phrase_mining._arrow(phrase_mining.RELATION))
    asked = pa.Table.from_batches(list(phrase_mining._asker(1)(iter([batch]))))
    answers = phrase_mining._counter(1, 30)(asked)
    found = np.frombuffer(answers["blob"].to_pylist()[-1], "<i8").reshape(-1, 4)
    assert sorted(map(tuple, found[:, 1:].tolist())) == [(3, 1 << 40, 400), (1 << 40, 3, 400)]
