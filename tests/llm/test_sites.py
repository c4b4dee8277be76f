"""URL filters and the quality classifier on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from patentloom.llm import quality
from patentloom.llm.url_reputation import domain_of, judge_urls, split_url, suffix_of


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""), ("", "", ""), ("no-scheme.org/a", "", ""), ("http://", "", ""),
        ("HTTP://WWW.Example.ORG", "www.example.org", ""), ("x://a.b/c?d#e", "a.b", "/c"),
        ("x://a.b?d/e", "a.b", ""), ("x://a.b#/e", "a.b", ""), ("x://É.com/A//b", "É.com", "/A//b"),
        ("a://b://c/d", "b:", "//c/d"), ("x://a\nb/c\nd?e", "a\nb", "/c\nd"),
    ],
)
def test_urls(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(*split_url(F.col("url"))).first()
    assert tuple(row) == (host, path)


def test_domains(spark):
    hosts = [("a.b.example.org",), ("example.co.uk",), ("m.example.co.uk",), ("org",), ("",)]
    rows = spark.createDataFrame(hosts, "h string").select("h", domain_of(F.col("h")), suffix_of(F.col("h")))
    assert [tuple(r)[1:] for r in rows.collect()] == [
        ("example.org", "org"), ("example.co.uk", "co.uk"), ("example.co.uk", "co.uk"),
        ("org", "org"), ("", ""),
    ]


def test_rules_and_reputation(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.example.org/x", "r"), (2, "http://example.org/es/1", "r"),
            (3, "http://m.example.org/en/12", "r"), (4, "http://example.org", "r"),
            (5, "http://x.com/fr/1", "r"), (6, "http://x.com/de/1", "r"),
            (7, "http://spam.net/1", "r"), (8, "http://new.spam.net/1", "r"),
            (9, "http://good.net/1", "r"), (10, None, "r"), (7, "http://spam.net/1", "r"),
        ],
        "page_id long, url string, rule string",
    )
    bad = [("spam.net", 1)] * 60 + [("other.net", 0)] * 60 + [("good.net", 0)] * 200
    outcomes = spark.createDataFrame([*bad, (None, 1), ("good.net", None)], "host string, bad int")
    out = judge_urls(pages, outcomes)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "bad_rate", "bad_bound", "verdict"]
    got = out.collect()
    assert len(got) == 11
    by_id = {r["page_id"]: (r["rule"], r["verdict"]) for r in got}
    assert by_id == {
        1: ("org/", "allow"), 2: ("example.org/es/", "block"), 3: ("example.org/en/1", "block"),
        4: (None, "allow"), 5: ("com/fr/", "allow"), 6: ("com/de/", "block"), 7: (None, "block"),
        8: (None, "block"), 9: (None, "allow"), 10: (None, "allow"),
    }


def test_reputation_of_empty_tables(spark):
    outcomes = spark.createDataFrame([], "host string, bad int")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(pages, outcomes).collect()] == ["allow"]
    assert judge_urls(pages.limit(0), outcomes).collect() == []


def test_quality(spark):
    rng = random.Random(5)
    words = ["stone", "river", "light", "paper", "green", "walk", "house", "tree", "open", "small"]

    def text(good):
        own = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        return " ".join(own) + "." if good else " ".join(w.upper() + "!!" for w in own)

    rows = [(i, text(i % 4 > 0), "x", 1) for i in range(400)]
    odd = [(None, text(True), "x", 1), (900, None, "x", 1), (901, "", "x", 1), (1, rows[1][1], "x", 1)]
    odd.append((902, "stone river, light. " * 50_000, "x", 1))
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, host string, good int")
    labels = spark.createDataFrame(
        [*((i, int(i % 4 > 0)) for i in range(250)), (None, 1), (3, None)], "doc_id long, quality int"
    )
    sites = spark.createDataFrame(
        [*((i, f"h{i % 3}", "p") for i in range(300)), (5, None, None), (None, "h", "p")],
        "doc_id long, host string, path string",
    )
    got = quality.score(docs, labels, sites).collect()
    assert len(got) == len(rows) + len(odd)
    keep = {r["doc_id"]: r["keep"] for r in got}
    assert sum(keep[i] == (i % 4 > 0) for i in range(250, 400)) >= 147
    assert all(0 < r["score"] < 1 for r in got) and None in keep and 900 in keep


def test_a_bad_site_decides_doubtful_texts(spark):
    docs = [(i, "stone river light " * (3 + i % 5)) for i in range(400)]
    labels = [(i, int(i % 2 == 0 or i % 20 == 1)) for i in range(300)]
    sites = [(i, "good.org" if i % 2 == 0 else "bad.org", "p") for i in range(400)]
    got = quality.score(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
        spark.createDataFrame(sites, "doc_id long, host string, path string"),
    ).collect()
    assert all(r["keep"] == (r["doc_id"] % 2 == 0) for r in got if r["doc_id"] >= 300)


def test_quality_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    sites = spark.createDataFrame([], "doc_id long, host string, path string")
    assert len(quality.score(docs, labels, sites).collect()) == 1
    assert quality.score(docs.limit(0), labels, sites).collect() == []
