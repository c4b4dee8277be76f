"""Substring dedup by words and bytes against brute force."""

import random
import re
from functools import partial

import numpy as np
import pytest

from patentloom.llm import automaton_dedup, suffix_dedup, windows
from patentloom.llm.arrays import Texts
from patentloom.llm.automaton_dedup import SuffixAutomaton, remove_repeated_words
from patentloom.llm.suffix_dedup import (
    longest_previous_factors,
    previous_smaller,
    remove_repeated_bytes,
)
from patentloom.llm.windows import Windows

SCHEMA = "doc_id long, text string, bucket string, part int, kept string"


def corpus(seed: int):
    """Short words in many copies, shared passages, periodic texts, nulls and repeated rows."""
    rng = random.Random(seed)
    words = ["a", "be", "éa", "the", "of", "to", "x" * 40, "日本"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", "  \n ", "it " * 90, "ab " * 50 + "it " * 60, "a\x00b " * 30]
    for _ in range(60):
        own = [rng.choice(words) + rng.choice(" \n\t ") for _ in range(rng.randrange(1, 120))]
        kind = rng.randrange(4)
        if kind == 0:
            at = rng.randrange(len(own))
            own[at:at] = [" " + passage[rng.randrange(40) :] + " "]
        if kind == 1 and texts[-1]:
            own = list(texts[-1])
            own[rng.randrange(len(own))] = "~"
        texts.append("".join(own))
    texts += texts[8:14] + [("z" * 300) + passage]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "x", 1, "y") for i, t in zip(ids, texts, strict=True)]
    return rows + [(None, passage, "x", 1, "y")]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def by_words(rows, width=20):
    seen, out = set(), {}
    for doc, text, *_ in in_order(rows):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            window = tuple(words[s : s + width])
            if window in seen:
                gone[s : s + width] = [True] * width
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc] = (len(words), sum(gone), kept)
    return out


def by_bytes(rows, width=50):
    first, out = {}, {}
    for doc, text, *_ in in_order(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - width + 1):
            if first.setdefault(data[s : s + width], doc) != doc:
                gone[s : s + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept)
    return out


@pytest.mark.parametrize("bucket_bytes", [300, 1 << 20])
def test_words_match_brute_force(spark, bucket_bytes):
    rows = corpus(bucket_bytes)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = remove_repeated_words(docs, bucket_bytes=bucket_bytes).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == by_words(rows)


@pytest.mark.parametrize("bucket_bytes", [300, 1 << 20])
def test_bytes_match_brute_force(spark, bucket_bytes):
    rows = corpus(bucket_bytes + 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = remove_repeated_bytes(docs, bucket_bytes=bucket_bytes).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (*tuple(r)[1:4], bytes(r["kept"])) for r in got} == by_bytes(rows)


def crowd(n: int):
    """A third of the rows hold one passage, each in words of its own."""
    rng = random.Random(n)

    def own(k):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))

    passage = own(60)
    texts = [f"{own(25)} {passage} {own(25)}" if i % 3 == 0 else own(60) for i in range(n)]
    return [(i, t, "x", 1, "y") for i, t in enumerate(texts + texts[:4])]


@pytest.mark.parametrize("bucket_bytes", [20_000, 1 << 20])
@pytest.mark.parametrize(
    "remove, want, module",
    [(remove_repeated_words, by_words, automaton_dedup), (remove_repeated_bytes, by_bytes, suffix_dedup)],
)
def test_passage_in_a_third_of_rows(spark, monkeypatch, remove, want, module, bucket_bytes):
    """Contexts at its edges are dealt by window: no part solves many around one anchor."""
    hot = 40
    solver = module._solver

    def checked(width):
        solve = solver(width)

        def run(records, tokens):
            counts = np.unique(records["a"], return_counts=True)[1]
            assert counts.max() <= hot, f"{counts.max()} contexts around one anchor"
            return solve(records, tokens)

        return run

    monkeypatch.setattr(module, "_solver", checked)
    monkeypatch.setattr(module, "Windows", partial(Windows, hot=hot))
    rows = crowd(1_200)
    got = remove(spark.createDataFrame(rows, SCHEMA), bucket_bytes=bucket_bytes).collect()
    plain = {r["doc_id"]: tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)[1:] for r in got}
    assert plain == want(rows)


@pytest.mark.parametrize("bucket_bytes", [300, 1 << 20])
def test_all_anchors_spread(spark, monkeypatch, bucket_bytes):
    for module in (automaton_dedup, suffix_dedup):
        monkeypatch.setattr(module, "Windows", partial(Windows, hot=1))
    rows = corpus(bucket_bytes)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = remove_repeated_words(docs, bucket_bytes=bucket_bytes).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == by_words(rows)
    got = remove_repeated_bytes(docs, bucket_bytes=bucket_bytes).collect()
    assert {r["doc_id"]: (*tuple(r)[1:4], bytes(r["kept"])) for r in got} == by_bytes(rows)


@pytest.mark.parametrize("remove", [remove_repeated_words, remove_repeated_bytes])
def test_empty_table_and_equal_rows(spark, remove):
    assert remove(spark.createDataFrame([], SCHEMA)).collect() == []
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "", 0, ""), (1, text, "", 0, ""), (2, text, "", 0, "")]
    got = remove(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["n_removed"] > 0) for r in got) == [
        (1, False), (1, False), (2, True)
    ]


def test_automaton_statistics():
    rng = random.Random(5)
    for _ in range(50):
        automaton, known = SuffixAutomaton(), []
        for _ in range(3):
            text = [rng.randrange(3) for _ in range(rng.randrange(30))]
            want = []
            for end in range(1, len(text) + 1):
                want.append(max(
                    n for n in range(end + 1)
                    if n == 0 or any(
                        k[i : i + n] == text[end - n : end] for k in known for i in range(len(k))
                    )
                ))
            assert automaton.matching_statistics(text) == want
            automaton.add(text)
            known.append(text)


def test_previous_factors():
    rng = np.random.default_rng(3)
    for _ in range(20):
        v = rng.integers(0, 9, 40)
        want = [max([j for j in range(i) if v[j] < v[i]], default=-1) for i in range(40)]
        assert previous_smaller(v).tolist() == want
        data, owner = rng.integers(97, 99, 60).astype(np.uint8), np.sort(rng.integers(0, 4, 60))
        at = np.arange(60 - 8)
        got = np.minimum(longest_previous_factors(data, owner, at, 8), 8)
        text = data.tobytes()
        want = [
            max((k for j in at if owner[j] < owner[i] for k in range(9)
                 if text[i : i + k] == text[j : j + k]), default=0)
            for i in at
        ]
        assert got.tolist() == want


@pytest.mark.parametrize("remove", [remove_repeated_words, remove_repeated_bytes])
def test_contexts_are_ranked_once(spark, plan_of, remove):
    """Documents are read by four passes, and no pass of the parts is repeated for another."""
    plan = plan_of(remove(spark.createDataFrame(corpus(1), SCHEMA)))
    passes = re.findall(r"FlatMap(\w*)GroupsInArrow", plan)
    assert (passes.count("Co"), passes.count("")) == (3, 4)


def test_contexts_do_not_depend_on_blocks(monkeypatch):
    spec = Windows(50, 19, False, np.dtype("u1"), suffix_dedup._tokenise, None)
    texts = [(t or "").encode() for _, t, *_ in corpus(2)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    bucket = Texts(np.arange(len(texts)), data, ends)
    whole = windows.contexts_of(bucket, spec)
    monkeypatch.setattr(windows, "BLOCK", 37)
    cut = windows.contexts_of(bucket, spec)
    for name in ("a", "c", "first", "last", "doc", "prefix"):
        assert (getattr(whole, name) == getattr(cut, name)).all()
    got = [w for a, b in zip(whole.first, whole.last, strict=True) for w in range(a, b + 1)]
    assert got == [w for a, b in zip(ends, ends[1:], strict=False) for w in range(a, b - 49)]
    equal = {}  # equal windows have one anchor
    for a, first, last in zip(whole.a, whole.first, whole.last, strict=True):
        for w in range(first, last + 1):
            assert equal.setdefault(data[w : w + 50].tobytes(), a) == a


def test_common_prefixes_up_to_a_depth():
    data = np.frombuffer(b"ab" * 300 + b"x" + b"ab" * 300 + b"\0", np.uint8)
    i, j = np.array([0, 1, 598, 0, 601, 1199]), np.array([2, 602, 1199, 601, 1, 1201])
    assert suffix_dedup.common_prefix(data, i, j, 500).tolist() == [500, 500, 2, 500, 0, 0]
    assert suffix_dedup.common_prefix(data, i, j, 700).tolist() == [598, 599, 2, 600, 0, 0]
