"""Record text, term weights, embeddings and lemmas."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from patentloom.functions import text as text_functions
from patentloom.operators import keywords, stitch
from patentloom.sinks.files import write_text_parts
from patentloom.sources import text as sources


def by_id(df):
    return {r[0]: r[1] for r in df.collect()}


RECORDS = {"1001": "first line second  line", "1002": "", "1003": 'says "yes" twice'}
BODY = '"1001"\t  first line\n second  line \n\n"1002"\t\n""\tno id\n"1003"\tsays "yes"\n\ttwice\n'


@pytest.mark.parametrize(
    "header", ["", '"patent_id"\t"summary_text"\n', "patent_id\tsummary_text\n", "h\nstray\n"]
)
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_quoted_records(spark, tmp_path, header, end):
    path = tmp_path / "part.tsv"
    path.write_text((header + BODY).replace("\n", end), newline="")
    assert by_id(sources.read_quoted_records(spark, str(path))) == RECORDS


HARD = (
    '"1"\tfirst\n""Smart"" device\nmore text\n"2"\tx\n"quoted" body\n"open end\n"D3"\ty\n"\n'
)


def test_lines_that_start_with_a_quote_stay_in_their_record(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('"patent_id"\t"summary_text"\n' + HARD)
    lines = sources.read_lines(spark, str(tmp_path))
    want = {"1": 'first ""Smart"" device more text', "2": 'x "quoted" body "open end', "D3": 'y "'}
    assert by_id(stitch.stitch_lines(lines)) == want
    assert by_id(sources.read_quoted_records(spark, str(tmp_path))) == want
    assert [r.rejected for r in sources.rejected_openings(lines).collect()] == [4]


def test_ids_of_another_form(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('"a-1"\tfirst\n"b"\tbody\n"a-2"\tsecond\n')
    got = sources.read_quoted_records(spark, str(tmp_path), id_pattern=r"a-\d+")
    assert by_id(got) == {"a-1": 'first "b"\tbody', "a-2": "second"}


def test_every_file_of_a_folder_has_its_own_header(spark, tmp_path):
    for number in (1, 2):
        (tmp_path / f"{number}.tsv").write_text(f'"patent_id"\t"text"\n"{number}"\ttext {number}\n')
    (tmp_path / ".hidden").write_text('"9"\thidden\n')
    (tmp_path / "empty").write_text("")
    assert by_id(sources.read_quoted_records(spark, str(tmp_path))) == {
        "1": "text 1", "2": "text 2",
    }


def long_text(path, records=60):
    lines = ['"patent_id"\t"summary_text"']
    expected = {}
    for r in range(records):
        body = [f"line {r} {i}" for i in range(r % 7 + 1)]
        lines += [f'"{r}"\t{body[0]}', *body[1:]]
        expected[str(r)] = " ".join(body)
    path.write_text("\n".join(lines) + "\n")
    return lines, expected


def test_split_keeps_order_and_cut_records_are_stitched(spark, tmp_path):
    source, parts = tmp_path / "in.txt", tmp_path / "parts"
    lines, expected = long_text(source)
    split = stitch.split_in_order(sources.read_lines(spark, str(source)), 10)
    write_text_parts(split, str(parts))
    files = sorted(parts.glob("part-*"))
    assert len(files) == 10
    contents = [f.read_text().splitlines() for f in files]
    assert [line for part in contents for line in part] == lines
    assert any(part and not part[0].startswith('"') for part in contents), "no record is cut"
    assert by_id(stitch.stitch_lines(sources.read_lines(spark, str(parts)))) == expected
    assert by_id(sources.read_quoted_records(spark, str(source))) == expected


def test_records_across_splits_of_one_file(spark, tmp_path):
    source = tmp_path / "in.txt"
    _, expected = long_text(source, 400)
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        lines = sources.read_lines(spark, str(source))
        assert lines.select("block").distinct().count() > 5
        assert by_id(stitch.stitch_lines(lines)) == expected
        assert by_id(sources.read_quoted_records(spark, str(source))) == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stop_words_are_the_library_default(spark):
    assert text_functions.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def random_docs(seed=7, count=30):
    rng = random.Random(seed)
    words = ["the", "of", *(f"w{i}" for i in range(25))]
    return {
        f"d{i}": " ".join(rng.choices(words, k=rng.randint(0, 40))) for i in range(count)
    } | {"blank": "  \t ", "doubled": "Cell  cell\nCELL"}


def test_tfidf_equals_brute_force(spark):
    docs = random_docs()
    counts = {
        key: Counter(w for w in body.lower().split() if w not in ("the", "of"))
        for key, body in docs.items()
    }
    frequency = Counter(term for bag in counts.values() for term in bag)
    expected = {}
    for key, bag in counts.items():
        scored = [
            (-round(n * math.log((len(docs) + 1) / (frequency[term] + 1)), 9), term)
            for term, n in bag.items()
        ]
        for rank, (score, term) in enumerate(sorted(scored)[:5], 1):
            expected[key, rank] = (term, -score)
    df = spark.createDataFrame(list(docs.items()), "patent_id string, summary_text string")
    got = keywords.tfidf_keywords(df, top_n=5)
    assert {(r.patent_id, r["rank"]): (r.keyword, r.score) for r in got.collect()} == expected
    lists = {r.patent_id: [k._1 for k in r.keywords] for r in keywords.keyword_lists(got).collect()}
    assert lists["doubled"] == ["cell"] and "blank" not in lists


def test_embedding_keywords_take_any_encoder(spark):
    class Lengths:
        """A word is (its length, 1), a text the sum over its words."""

        def encode(self, texts):
            return np.array([np.sum([(len(w), 1) for w in t.split()], axis=0) for t in texts])

    docs = spark.createDataFrame(
        [("a", "The cell, a CELL and transistors!"), ("b", "of the"), ("c", None)],
        "patent_id string, summary_text string",
    )
    got = {r.patent_id: r.keywords for r in
           keywords.embedding_keywords(docs, Lengths, 2).collect()}
    # The document is 2 * (4, 1) + (11, 1) = (19, 3).
    assert [tuple(k) for k in got["a"]] == [
        ("transistors", round(212 / math.sqrt(122 * 370), 4)),
        ("cell", round(79 / math.sqrt(17 * 370), 4)),
    ]
    assert got["b"] == [] and got["c"] == []


# Written by hand. Singulars that are not terms of the corpus themselves are added to it.
LEMMAS = {
    "networks": "network", "matrices": "matrix", "batteries": "battery", "switches": "switch",
    "boxes": "box", "classes": "class", "process": "process", "bus": "bus", "valves": "valve",
    "cell": "cell", "children": "child", "analysis": "analysis", "caches": "cache",
    "sizes": "size", "viruses": "virus", "lens": "lens", "bias": "bias", "gas": "gas",
    "series": "series", "species": "species", "gps": "gps", "dns": "dns", "lenses": "lens",
    "widgets": "widgets", "is": "is",
}
SINGULARS = {v for k, v in LEMMAS.items() if k != v} | {"len", "bia", "ga", "gp", "dn", "specie"}


def test_lemmas(spark):
    words = [*LEMMAS, *sorted(SINGULARS - set(LEMMAS)), " ", None, "networks"]
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    rows = keywords.lemmatized(df).collect()
    assert len(rows) == len(words) - 2
    got = {r.keyword: r.normalized_keyword for r in rows}
    assert {w: got[w] for w in LEMMAS} == LEMMAS
    assert all(got[w] == w for w in SINGULARS)


def test_a_given_lemma_table_counts_first_and_multiplies_nothing(spark):
    df = spark.createDataFrame([("mice",), ("cats",), ("cat",)], "keyword string")
    table = spark.createDataFrame(
        [("mice", "rodent"), ("mice", "zz"), ("cats", "feline"), ("cats", "feline")],
        "word string, lemma string",
    )
    got = sorted((r.keyword, r.normalized_keyword) for r in keywords.lemmatized(df, lemmas=table).collect())
    assert got == [("cat", "cat"), ("cats", "feline"), ("mice", "rodent")]


def test_parts_are_dealt_without_a_sample_of_the_lines(spark, tmp_path, plan_of):
    source, parts = tmp_path / "in.txt", tmp_path / "parts"
    lines, _ = long_text(source, 400)
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        split = stitch.split_in_order(sources.read_lines(spark, str(source)), 7)
        # A range exchange collects up to 300 keys per part, file paths included.
        assert "rangepartitioning" not in plan_of(split)
        write_text_parts(split, str(parts))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    contents = [f.read_text().splitlines() for f in sorted(parts.glob("part-*"))]
    assert [line for part in contents for line in part] == lines
    assert {len(part) for part in contents} <= {len(lines) // 7, len(lines) // 7 + 1}
    assert len(contents) == 7


def test_tfidf_asks_once_per_group_of_documents(spark, plan_of, monkeypatch):
    monkeypatch.setattr(keywords, "DOCUMENTS_PER_GROUP", 3)
    bodies = random_docs(11, 40)
    rows = [*bodies.items(), ("d1", "w3 w3 extra"), ("none", None), (None, "w1 lone"), (None, "lone")]
    df = spark.createDataFrame(rows, "patent_id string, summary_text string")
    counts = {}
    for key, body in rows:
        counts.setdefault(key, Counter()).update(
            w for w in (body or "").lower().split() if w not in ("the", "of")
        )
    frequency = Counter(term for bag in counts.values() for term in bag)
    expected = {}
    for key, bag in counts.items():
        scored = [
            (-round(n * math.log((len(rows) + 1) / (frequency[term] + 1)), 9), term)
            for term, n in bag.items()
        ]
        for rank, (score, term) in enumerate(sorted(scored)[:4], 1):
            expected[key, rank] = (term, bag[term], frequency[term], -score)
    got = keywords.tfidf_keywords(df.repartition(5), top_n=4)
    found = {(r.patent_id, r["rank"]): (r.keyword, r.tf, r.doc_freq, r.score) for r in got.collect()}
    assert found == expected
    # Rows per document and term are shuffled by group only, never by term.
    assert "FlatMapCoGroupsInArrow [part" in plan_of(got) and "Union" not in plan_of(got)
