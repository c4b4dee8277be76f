"""Encoding against the library, decoding, and the two folds against plain searches."""

import itertools
import os
import random

import pyarrow as pa
import pytest
import sentencepiece

from patentloom.llm import sentencepiece_lattice as lattice
from patentloom.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, ids string, bucket int, unit string"

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")


@pytest.fixture(scope="module")
def pieces():
    return lattice.load(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


def texts():
    rng = random.Random(2)
    words = ["the", "of", "Internationalisation", "éàü", "日本語", "x" * 70, "🙂", "<s>", "\x00", "ﬁ"]
    out = ["", " ", "  a  b ", "\n\n", "a\tb\r\nc", "Hello world", "ab" * 3000, " " * 100, "\n" * 70]
    for _ in range(40):
        seps = [" ", "  ", "\n", "\t", ".", ", ", ""]
        out.append("".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(40))))
    return out


def test_encodes_as_the_library_and_back(spark, pieces, library):
    own = texts()
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(own)]
    rows += [(None, "a b", "", 0, ""), (-7, None, "", 0, ""), (3, own[3], "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    encoded = lattice.encode(docs, pieces, bucket_bytes=2_000)
    got = lattice.decode(encoded, pieces).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["text"] is None:
            assert (r["doc_id"], r["ids"], r["decoded"]) == (-7, None, None)
        else:
            assert r["ids"] == library.encode(r["text"]), r["text"]
            assert r["decoded"] == r["text"]
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}


def test_units_are_cut_where_no_piece_spans(pieces):
    import re

    pattern = lattice.unit_pattern(pieces)
    for text in texts():
        assert "".join(re.findall(pattern, text.replace(" ", "▁"))) == text.replace(" ", "▁")
    cut = re.findall(pattern, "▁▁It's,▁(2021)...é-x\n▁▁")
    assert cut == ["▁▁It", "'", "s", ",", "▁(", "2", "0", "2", "1", ")...", "é", "-", "x", "\n", "▁▁"]
    for name, ok in zip(pieces.names, pieces.plain, strict=True):
        assert not ok or re.findall(pattern, name) == [name]


def test_long_units_follow_the_same_rule(pieces, library):
    encoder = lattice.Encoder(pieces, 48)
    for text in texts():
        assert encoder.encode(text, {}).tolist() == library.encode(text)


def test_empty_table(spark, pieces):
    docs = spark.createDataFrame([], SCHEMA)
    assert lattice.decode(lattice.encode(docs, pieces), pieces).collect() == []


def test_viterbi_fold_finds_the_best_path(spark):
    rng = random.Random(6)
    names = ["a", "b", "c", "ab", "bc", "abc", "ca", "aab", "▁", "▁a", "▁ab"]
    scores = [-rng.uniform(1, 9) for _ in names]
    toy = lattice.Pieces("unigram", tuple(names), tuple(scores), (True,) * len(names), 0)
    own = dict(zip(names, scores, strict=True))
    unknown = lattice.unknown_score(toy)

    def total(path):
        return sum(own.get(p, unknown if len(p) == 1 else -1e9) for p in path)

    def best(unit):
        cuts = range(1, len(unit))
        paths = []
        for k in range(len(unit)):
            for at in itertools.combinations(cuts, k):
                ends = (0, *at, len(unit))
                paths.append([unit[i:j] for i, j in zip(ends, ends[1:], strict=False)])
        return max(map(total, paths))

    units = ["".join(rng.choice("abcz") for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    units = sorted({"▁" + u for u in units} | set(units))
    rows = spark.createDataFrame([(u,) for u in units], "unit string")
    got = {r["unit"]: r["pieces"] for r in lattice.lattice_paths(rows, toy).collect()}
    for unit in units:
        plain = lattice.best_path(unit, own, toy.longest, unknown)
        assert total(plain) == pytest.approx(best(unit))
        if unit in got:
            assert "".join(got[unit]) == unit
            assert total(got[unit]) == pytest.approx(best(unit))
    assert got


def test_units_are_cut_and_looked_up_in_columns(pieces, library):
    """Texts with odd blanks, U+2581 and characters outside the table, as the library has them."""
    rng = random.Random(9)
    words = ["a", "It's", "12", "9a", "é.", "\n", "\tb", "▁", "c▁", "▁d", "日本語", "𐍈", "x" * 60, "(!)", "\r"]
    cases = [None, "", " ", "  ", "\n", "▁", "a▁ b", " a", "a ", "1", " 1", "a  b"]
    cases += ["".join(rng.choice(words) + rng.choice([" ", "", "  "]) for _ in range(9)) for _ in range(200)]
    encoder = lattice.Encoder(pieces, 48)
    words = lattice.Words.split(encoder, pa.array(cases))
    dealt = lattice.Dealt(encoder, words.units, 7)
    blobs = dealt.blobs(words.units)
    assert sum(len(b.split(b" ")) for b in blobs) == len(dealt.order)
    schema = lattice.ASKED
    asked = pa.table(
        [pa.array(dealt.parts, pa.int32()), pa.array([3] * len(blobs)), pa.array(map(lattice._squeezed, blobs), pa.binary())],
        schema=schema,
    )
    own = lattice._different(asked)["unit"].to_pylist()
    paths = [(u, encoder.path(u)) for u in own]
    paths = [(u, p) for u, p in paths if len(p) < len(u)]  # those without an edge are not there
    sent = type("Sent", (), {"value": pieces})
    answers = lattice._answers(sent, 48)(
        asked,
        pa.table({"unit": [u for u, _ in paths], "pieces": pa.array([p for _, p in paths], pa.list_(pa.string()))}),
    )
    said = dict(zip(answers["part"].to_pylist(), answers["blob"].to_pylist(), strict=True))
    ids = words.ids(*lattice._replied(encoder, words.units, dealt, said))
    assert ids.to_pylist() == [library.encode(c or "") for c in cases]


def test_texts_that_hold_the_blanks_own_mark(spark, pieces, library):
    rows = [(1, "a▁ b", 1), (2, "▁ ▁", 1), (3, "c▁", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = {r["doc_id"]: r["ids"] for r in lattice.encode(docs, pieces).collect()}
    assert got == {i: library.encode(t) for i, t, _ in rows}
