"""The pipeline's stages against brute force on the smallest tables."""

import os

import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from patentloom.llm import toxicity
from patentloom.llm.queries import TOKENIZER, read, toxicity_model
from tests.llm import test_benchmark_scan, test_ngram_join

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents of the smallest tables and some odd rows."""
    table = read(spark, SF_DIR, "documents").select(*pipeline.COLUMNS)
    odd = [(None, "a b c", "en", "s", 5), (-1, None, "en", None, None), (-2, "", None, "s", 0)]
    return table.unionByName(spark.createDataFrame(odd, SCHEMA))


def stage(name):
    return dict(pipeline.STAGES)[name]


def by_id(df):
    return {r["doc_id"]: tuple(r) for r in df.collect()}


def test_the_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"
    ]
    assert entry.queries()["pipeline"] is pipeline.run


def test_toxic_documents_go_and_others_stay_unchanged(spark, docs):
    got, rows = by_id(stage("toxicity")(spark, docs, SF_DIR)), by_id(docs)
    scored = toxicity.score(docs, toxicity_model(spark, docs, SF_DIR)).collect()
    want = {r["doc_id"] for r in scored if r["predicted"] == 0}
    assert got == {i: rows[i] for i in want}
    toxic = {
        r["doc_id"] for r in read(spark, SF_DIR, "labels").where("toxic = 1").collect()
    }
    # Accuracy has a test of its own; these tables have a few dozen labels.
    assert toxic - set(got)
    assert len(set(rows) - set(got) - toxic) <= 0.05 * len(rows)


def test_lines_that_stand_earlier_go(spark, docs):
    got, seen, want = by_id(stage("line_dedup")(spark, docs, SF_DIR)), set(), {}
    rows = by_id(docs)
    for i in sorted(rows, key=lambda i: (i is None, i or 0)):
        text = rows[i][1]
        kept = []
        for line in (text or "").split("\n"):
            if not line.strip(" ") or line not in seen:
                kept.append(line)
            seen.add(line)
        want[i] = None if text is None else "\n".join(kept)
    assert set(got) == set(rows)
    # The tables hold hardly any lines within one edit of each other.
    same = [i for i in rows if got[i][1] == want[i]]
    assert len(same) >= len(rows) - 3
    for i in rows:
        assert got[i][2:4] == rows[i][2:4]
        changed = got[i][1] != rows[i][1]
        assert got[i][4] == (len(got[i][1]) if changed else rows[i][4])


def test_one_document_of_each_group_stays(spark, docs):
    got, rows = by_id(stage("ngram_jaccard_join")(spark, docs, SF_DIR)), by_id(docs)
    found = test_ngram_join.brute([(i, r[1]) for i, r in rows.items()])
    assert got == {i: rows[i] for i, _, component in found if i is None or component == i}
    assert len(got) < len(rows)


def test_contaminated_documents_go(spark, docs):
    got, rows = by_id(stage("benchmark_decontamination")(spark, docs, SF_DIR)), by_id(docs)
    windows = set()
    for item in read(spark, SF_DIR, "benchmark").collect():
        words = test_benchmark_scan.words(item["text"])
        size = min(10, len(words))
        windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1) if size}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = test_benchmark_scan.words(text)
        return not any(
            tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1)
        )

    assert got == {i: r for i, r in rows.items() if clean(r[1])}
    assert len(got) < len(rows)


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
def test_run_encodes_what_the_stages_keep(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    out = pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "ids", "n_pieces", "round_trip"]
    got = out.collect()
    kept = read(spark, SF_DIR, "documents")
    for _, function in pipeline.STAGES[:-1]:
        kept = function(spark, kept, SF_DIR)
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["ids"] == library.encode(texts[r["doc_id"]])
        assert r["n_pieces"] == len(r["ids"]) and r["round_trip"]
