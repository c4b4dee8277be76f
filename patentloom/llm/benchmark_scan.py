"""Benchmark decontamination with one Aho-Corasick automaton.

All word windows of the normalised benchmark items become patterns of one automaton. Each
document is normalised and scanned once, whatever the number of items, and the words that
matches cover are mapped back to byte offsets of the original text.

The patterns are broadcast, so their size is checked: a benchmark larger than
``shard_bytes`` is cut into shards, each with an automaton of its own, which the same pass
over the documents goes through one after another. Nothing is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from patentloom.llm.arrays import releasing
from patentloom.session import ship_package

#: Bytes of a word: digits, letters, everything beyond ASCII. Others become blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
RESULTS = ("n_words", "n_hit", "items", "spans", "contaminated")

#: The last automaton of this worker, by the scan it belongs to.
_automata: dict[str, ahocorasick.Automaton] = {}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def patterns_of(items: Iterable[tuple[object, bytes | None]], window: int) -> dict:
    """Blank-delimited window -> (number of words, item ids as strings)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            pattern = (b" " + b" ".join(words[i : i + size]) + b" ").decode("latin-1")
            ids = found.setdefault(pattern, (size, set()))[1]
            if item is not None:
                ids.add(str(item))
    return found


def _automaton(patterns: dict) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        automaton.add_word(pattern, value)
    automaton.make_automaton()
    return automaton


def _cached(broadcast, name: str) -> ahocorasick.Automaton:
    if name not in _automata:
        _automata.clear()
        _automata[name] = _automaton(broadcast.value)
    return _automata[name]


def merged(intervals: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals as disjoint, sorted ones."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan_text(text: bytes | None, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, covered word intervals, and items of the matches."""
    words = words_of(text)
    if not words or not len(automaton):
        return len(words), [], set()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    matches = list(automaton.iter(line))
    if not matches:
        return len(words), [], set()
    blanks = [0, *accumulate(len(w) + 1 for w in words)]  # places of the blanks in line
    last = np.searchsorted(blanks, [end for end, _ in matches])  # words before that blank
    cover = merged((int(n) - size, int(n)) for n, (_, (size, _)) in zip(last, matches, strict=True))
    return len(words), cover, set().union(*(ids for _, (_, ids) in matches))


def byte_spans(text: bytes, cover: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """UTF-8 byte offsets of covered words in the original text."""
    is_word = np.frombuffer(text.translate(WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in cover]


def _scanner(text: str, broadcast, schema: pa.Schema, kept: list[str]):
    # Not the texts: another benchmark may hold the same ones under other ids.
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _cached(broadcast, name)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            before = batch.column(batch.schema.get_field_index("_cover")).to_pylist()
            known = batch.column(batch.schema.get_field_index("_items")).to_pylist()
            counts, covers, items, spans = [], [], [], []
            for value, old, ids in zip(texts, before, known, strict=True):
                value = value.as_py()
                n, cover, found = scan_text(value, automaton)
                if old:
                    cover = merged([*cover, *((s["start"], s["end"]) for s in old)])
                counts.append(n)
                covers.append([{"start": a, "end": b} for a, b in cover])
                items.append(sorted(found | set(ids)))
                at = byte_spans(value, cover) if cover else []
                spans.append([{"start": a, "end": b} for a, b in at])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            new = [
                pa.array(x, schema.field(name).type)
                for name, x in (
                    ("_n", counts), ("_cover", covers), ("_items", items), ("_spans", spans)
                )
            ]
            arrays = [c.cast(schema.field(n).type) for n, c in zip(kept, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, *new], schema=schema)

    return run


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shard_bytes: int = 64 << 20,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items, spans (byte offsets) and contaminated.

    Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. An
    item with fewer than ``window`` words is one window; one without words never matches.
    Null texts have no words. An item with a null id still marks words but is not listed;
    repeated items count once. Columns of ``docs`` with a result's name are replaced; all
    others, and every row, stay. An empty benchmark or document table is fine.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    items = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).cast("binary").alias("t"))
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    spans = ArrayType(SPAN)
    kept = [c for c in docs.columns if c not in RESULTS or c == text]
    out = docs.select(
        *kept,
        F.lit(0).alias("_n"),
        F.array().cast(spans).alias("_cover"),
        F.array().cast(ArrayType(StringType())).alias("_items"),
        F.array().cast(spans).alias("_spans"),
    )
    for k in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("t"), F.lit(shards)) == k)
        rows = ((r["i"], None if r["t"] is None else bytes(r["t"])) for r in part.toLocalIterator())
        sent = docs.sparkSession.sparkContext.broadcast(patterns_of(rows, window))
        schema = to_arrow_schema(out.schema)
        out = out.mapInArrow(releasing(_scanner(text, sent, schema, kept)), out.schema)
    hit = F.aggregate("_cover", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select(
        *kept,
        F.col("_n").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.col("_items").alias("items"),
        F.col("_spans").alias("spans"),
        (F.size("_cover") > 0).alias("contaminated"),
    )
