"""The filter audit against a walk through every order."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from patentloom.llm import filter_audit

DOCS = "doc_id long, text string, lang string, part int, mask string, n int"
LABELS = "doc_id long, quality int, toxic int"


def brute_fails(rows):
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        fails += "D" if re.search(r"[#$%&*|]", text) else ""
        smaller = i is not None and any(
            (t or "") == text and j is not None and j < i for j, t, *_ in rows
        )
        out.append(fails + ("E" if smaller else ""))
    return out


def brute_audit(rows, labels, fails, letters="ABCDE"):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        shapley = dict.fromkeys(letters, 0)
        for order in itertools.permutations(letters):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                failing = sum(f in d[1] for d in docs)
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(d[1] == f for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f,
                ]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = shapley[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    df = filter_audit.audit_documents(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    )
    assert df.columns == ["part", "filter_order", "step", *filter_audit.MEASURES]
    got = df.collect()
    assert len({tuple(r)[:3] for r in got}) == len(got)
    return {tuple(r)[:3]: tuple(r)[3:] for r in got}


def sample(rng, i):
    pool = rng.choice([8, 400])
    words = [f"w{rng.randrange(pool)}" for _ in range(rng.choice([5, 150, 199, 200, 260]))]
    if rng.random() < 0.3:
        words = [w.upper() for w in words]
    if rng.random() < 0.3:
        words.append(rng.choice("#$%&*|"))
    text = rng.choice([" ", "\n", "\t "]).join(words)
    return (i, text, rng.choice(["en", "fr", None]), 1, "m", 2)


def test_every_order_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [sample(rng, i) for i in range(60)]
    rows += [(100 + k, rows[k % 7][1], rng.choice(["en", "fr"]), 1, "m", 2) for k in range(30)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(None, rows[3][1], "en", 1, "m", 2)] * 2 + [(None, "lonely", None, 1, None, None)]
    rows += [(-4, None, "", 1, "m", 2), (300, "", "fr", 1, "m", 2), (301, "   \n", None, 1, "m", 2)]
    rows += [(400, "é" * 97 + "ABC", "en", 1, "m", 2), (401, "é" * 96 + "ABCD", "en", 1, "m", 2)]
    rows += [(402, "long " * 300_000, "en", 1, "m", 2)]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 130, 2)]
    labels += [(4, 1, None), (4, 0, 1), (None, 1, 1)]
    assert audited(spark, rows, labels) == brute_audit(rows, labels, brute_fails(rows))


def test_without_documents_or_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    got = audited(spark, [(1, "x", "en", 1, "m", 2)], [])
    assert len(got) == 600
    assert got["en", "BCDEA", 5] == (0, 1, 0, 1, 0, 0, 120)
    assert got["en", "BCDEA", 1] == (1, 0, 0, 0, 0, 0, 0)


def test_a_hot_text_is_one_row_per_part_before_the_last_shuffle(spark, plan_of):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"),
    )
    labels = spark.createDataFrame([(3, 1, 0)], LABELS)
    failures = {"A": F.length("text") < 2}
    cells = filter_audit.masks(docs, labels, failures)
    got = {r["mask"]: r["n"] for r in cells.collect()}
    short = sum(k % 3 > 0 for k in range(10))
    assert got == {0: 2001 - short, 1: short, 2: 999}
    assert "Python" not in plan_of(cells)


def test_other_filter_sets(spark):
    cells = spark.createDataFrame(
        [("x", 0, 5, 1, 0), ("x", 1, 3, 0, 1), ("x", 3, 2, 2, 0)],
        "part string, mask int, n long, good long, toxic long",
    )
    got = {(r[1], r[2]): tuple(r)[3:] for r in filter_audit.audit(cells, "PQ").collect()}
    assert got == {
        ("PQ", 1): (5, 5, 0, 3, 2, 1, 8), ("PQ", 2): (5, 0, 2, 0, 0, 0, 2),
        ("QP", 1): (8, 2, 0, 0, 2, 0, 2), ("QP", 2): (5, 3, 2, 3, 0, 1, 8),
    }
    for letters in ("A", "AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            filter_audit.audit(cells, letters)
