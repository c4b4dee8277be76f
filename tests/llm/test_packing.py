"""Packed sequences: whole documents, no gaps, no padding."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patentloom.llm import packing
from patentloom.llm.queries import PACKED_TOKENIZER

SCHEMA = "doc_id long, text string, n long, task string, ids int"


def test_plans_place_every_remainder_once_without_padding():
    rng = np.random.default_rng(5)
    cases = [np.zeros(64, int), rng.integers(0, 50, 64), rng.integers(0, 2, 64)]
    hot = np.zeros(64, int)
    hot[[1, 37]] = 5000, 900
    few = np.zeros(64, int)
    few[63] = 1
    for counts in [*cases, hot, few]:
        planned = packing.plan(counts, 64)
        held = defaultdict(list)
        for rest in range(1, 64):
            for rank in range(counts[rest]):
                pieces = planned.pieces(rest, rank)
                assert pieces[0][0] == 0
                assert [p[0] + p[1] for p in pieces] == [p[0] for p in pieces[1:]] + [rest]
                for _, length, sequence, offset in pieces:
                    held[sequence].append((offset, length))
        full = 0
        for spans in held.values():
            end = 0
            for offset, length in sorted(spans):
                assert offset == end
                end += length
            assert end == 64 or end & (end - 1) == 0
            full += end == 64
        assert sorted(held) == list(range(planned.sequences))
        assert len(held) - full <= 6


def test_least_squares_repeats_what_fills_a_sequence():
    counts = np.zeros(65, int)
    counts[[40, 24, 20, 4]] = 300, 200, 80, 40
    columns, x = packing.least_squares(counts, 64)
    assert (x >= 0).all()
    assert ((columns.length * columns.times).sum(1) == 64).all()
    # 200 x (40, 24), 40 x (20, 20, 20, 4) are not enough for all 40s: the rest stays.
    planned = packing.plan(counts[:64], 64)
    assert planned.used[24] == 200 and planned.used[40] >= 200
    # The conditions of a least-squares optimum with x >= 0, over the columns generated.
    slope = columns.gains(np.arange(65) / 64 * (counts - columns.product(x)))
    assert (slope < 2).all()
    assert np.abs(slope[x > 1]).max() < 2


def held_up(spark, rows, width, end_id=2, hot=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = packing.pack(df, PACKED_TOKENIZER, end_id, width).collect()
    model = Tokenizer.from_file(PACKED_TOKENIZER)
    want = Counter()
    for i, text, *_ in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [end_id]
        want[i, len(ids)] += len(ids)
    sequences = defaultdict(list)
    covered = Counter()
    for r in got:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id, r.doc_tokens] += r.length
    assert covered == want
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end == width or (end < width and end & (end - 1) == 0)
    return got, model


def test_ids_cover_every_document_with_odd_rows(spark):
    rng = random.Random(1)
    words = ["It's", "don't", "soé", "éx", "A1.", "#tag", "日本語", "<|endoftext|>", "\x1c", "12,5", "ΣΑΣ", "end.", "End.'s", "é.", "a.,", "<|ENDOFTEXT|>", "İ"]
    texts = [
        "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", "\xa0", "\x0b"]) for _ in range(n))
        for n in (0, 1, 3, 30, 31, 62, 63, 64, 500, 3000)
    ]
    rows = [(i, t, 1, "a", 2) for i, t in enumerate(texts)]
    rows += [(50, None, 1, "a", 2), (51, "", 1, None, None), (-9, "  \n ", 1, "a", 2)]
    rows += [(60, "same text here", 1, "a", 2)] * 7 + [(61, "x" * 5000, 1, "a", 2)]
    rows += [(k, "a hot text of all copies", 1, "a", 2) for k in range(100, 400)]
    got, model = held_up(spark, rows, 64)
    for i, text in enumerate(texts):
        pieces = sorted((r.start, r.ids) for r in got if r.doc_id == i)
        ids = np.frombuffer(b"".join(p for _, p in pieces), "<u4").tolist()
        assert ids == model.encode(text, add_special_tokens=False).ids + [2]
        ends = [s + len(p) // 4 for s, p in pieces]
        assert [s for s, _ in pieces] == [0, *ends[:-1]]


def test_null_ids_and_no_documents(spark):
    got, _ = held_up(spark, [(None, "a b", 1, "a", 2), (None, None, 1, "a", 2)], 64)
    assert {r.doc_id for r in got} == {None}
    empty = packing.pack(spark.createDataFrame([], SCHEMA), PACKED_TOKENIZER, 2, 64)
    assert empty.collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], SCHEMA), PACKED_TOKENIZER, 2, 100)


def test_few_documents_are_cut(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    got = packing.pack(docs, PACKED_TOKENIZER, 2)
    per = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    total = got.agg(F.sum("length"), F.count("*")).first()
    model = Tokenizer.from_file(PACKED_TOKENIZER)
    texts = [r.text or "" for r in docs.select("text").collect()]
    assert total[0] == sum(len(t.ids) + 1 for t in model.encode_batch(texts, add_special_tokens=False))
    assert got.select("doc_id").distinct().count() == len(texts)
    sequences = per.collect()
    assert sum(1 for s in sequences if s.n < packing.WIDTH) <= 12
    least = docs.count() + sum(d // packing.WIDTH for (d,) in got.select("doc_id", "doc_tokens").distinct().select("doc_tokens").collect())
    # One cut per sequence would be what concatenation makes.
    assert total[1] - least <= total[0] / packing.WIDTH


def test_remembered_chunks_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    with open(PACKED_TOKENIZER, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), 2)
    rng = random.Random(6)
    for _ in range(30):
        words = [rng.choice(["the", "The", "x9"]) + rng.choice(["", ".", "q" * rng.randrange(60)]) for _ in range(40)]
        text = " ".join(words)
        assert encoder.encode(pa.array([text, None])) == [encoder._ids([text])[0] + encoder.end, encoder.end]
    assert encoder.old and len(encoder.young) <= 20


def test_a_tokenizer_that_joins_over_blanks_is_refused(tmp_path):
    from tokenizers import Tokenizer as T
    from tokenizers import models

    model = T(models.WordLevel({"[UNK]": 0, "a": 1}, unk_token="[UNK]"))
    with pytest.raises(ValueError):
        packing.Encoder(model.to_str(), 2).check("a b")


def test_words_are_looked_up_without_their_marks():
    with open(PACKED_TOKENIZER, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), 2)
    given = []
    ids_of = encoder._ids
    encoder._ids = lambda texts: given.extend(" ".join(texts).split()) or ids_of(texts)
    words = [f"{a}{b}" for a in ("un", "día", "É", "x9") for b in ("a", "é", "7", "tion")]
    marks = ["###", "&&&", ".", "'s", ",%", "]'d", "=b", "", "̸"]
    text = " ".join(w + m for w in words for m in marks)
    got = encoder.encode(pa.array([text, "<|endoftext|> a", "", None, text[:70]]))
    assert len(given) < len(words) * 4 + 20
    for ids, whole in zip(got, [text, "<|endoftext|> a", "", "", text[:70]], strict=True):
        assert ids == ids_of([whole])[0] + encoder.end


def test_every_mark_behind_a_letter():
    with open(PACKED_TOKENIZER, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), 2)
    letters = ["a", "Z", "0", *map(chr, range(0xAA, 0x180)), "ſ", "ŉ", "ß", "日", "á", "Σ"]
    marks = [chr(c) for c in range(33, 127)]
    texts = [f"{a}{m} {a}{m}{m}b {a}{m}̸ {a}{m}'s {a}'{m}" for a in letters for m in marks]
    for got, text in zip(encoder.encode(pa.array(texts)), texts, strict=True):
        assert got == encoder._ids([text])[0] + encoder.end, text
