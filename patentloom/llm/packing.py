"""Token sequences of fixed width, packed by non-negative least squares.

A document of n tokens gives ``n // width`` sequences of its own; what remains, shorter than a
sequence, is packed by its length alone:

1. The histogram of remainders, ``width`` counts whatever the corpus, is the right-hand side
   of a least squares problem. Its unknowns say how often each shallow combination (up to
   three different lengths, the first any number of times) that fills a sequence is repeated.
   Columns are generated where they would reduce the error most, in a few rounds.
2. The solution is rounded to whole repetitions within the counts; combinations that the
   counts still allow are then taken greedily.
3. What is left is laid end to end and cut at the width, at most once per sequence. The last
   sequence is cut at powers of two, which need no padding either: none is left at all.

Where a remainder goes depends on its length and its rank among its equals only. Ranks come
from counts per task, so each document finds its place without a group: sequences are never
gathered in one task, and neither are the equals of a very frequent length.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentloom.session import ship_package
from patentloom.sinks.files import written

WIDTH = 4096
#: Sequences of one document only are numbered from here on, the packed ones from 0.
OWN = 1 << 62
PROBE = "It's  soé\ńx   A1.\t#don't WORD, word,\x0b\x1c ok?! 12. ab..\n»., x<|y " + " ".join(
    f"a{c} é{c}x É{c}{c}'s 7{c}8 {c}'d" for c in map(chr, range(33, 127)) if not c.isalnum()
)
#: Own sequences of one task.
OWN_PER_TASK = 36
RANKS = 1 << 40
#: Chunks of text whose ids a worker remembers, twice this number, and the longest of them.
REMEMBERED, LONGEST = 250_000, 40

#: ASCII punctuation but the apostrophe, behind a digit, an ASCII letter or one of Latin-1, is
#: never joined to it.
CLOSING = r"([a-z0-9À-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"

TOKENS = "doc_id long, task int, rest int, nth long, own long, n long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


# Tokens.


class Encoder:
    """Ids of texts, by chunks between ASCII white space.

    The tokenizer must drop white space, never join what it separates, ignore the case of
    ASCII letters and split punctuation off words (``CLOSING``), so that a word has the same
    ids wherever it stands; ``check`` holds that against the tokenizer. The different chunks of
    some texts are cut before their punctuation, and the different words and marks that gives
    are looked up once. Texts that hold a special token are given to the tokenizer whole. Words
    met again stay remembered, those of two generations ago do not.
    """

    def __init__(self, model: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_str(model)
        self.end = array("I", [end_id]).tobytes()
        special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.special = special
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        names = self.model.get_vocab()
        self.ends = np.zeros(max(names.values(), default=-1) + 1, bool)
        self.ends[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        # The fast one leaves out where in the text a token stands.
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only; each ends with the only token that ends a word."""
        out: list[bytes] = []
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            raw = self._ids([" ".join(some)])[0]
            cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) * 4 + 4).tolist()
            if len(cuts) == len(some):
                out += [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
            else:
                out += self._ids(some)
        return out

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of different words and marks."""
        out = list(map(self.young.get, parts))
        at = [i for i, ids in enumerate(out) if ids is None]
        new = [parts[i] for i in at]
        ids_of = {p: self.old[p] for p in new if p in self.old}
        words = [p for p in new if p not in ids_of and p.isalpha()]
        ids_of.update(zip(words, self._word_ids(words), strict=True))
        others = [p for p in new if p not in ids_of]
        ids_of.update(zip(others, self._ids(others), strict=True))
        for i, part in zip(at, new, strict=True):
            out[i] = ids_of[part]
        self.young.update(ids_of)
        for part in new:
            if len(part) > LONGEST:
                del self.young[part]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {"": b""}
        return out

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and where those of a text begin."""
        texts = texts.fill_null("")
        marked = np.zeros(len(texts), bool)
        for token in self.special:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(marked), "", texts)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        chunks = lists.flatten().dictionary_encode()
        cut = pc.replace_substring_regex(chunks.dictionary, CLOSING, r"\1 \2")
        parts = pc.ascii_split_whitespace(cut)
        words = parts.flatten().dictionary_encode()
        own = self._known(words.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(own), "<u4")
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        # Behind the chunks: the end, and the texts that are given whole.
        whole = self._ids([texts[i].as_py() for i in np.flatnonzero(marked).tolist()])
        more = [self.end, *whole]
        found = _rows(ids, sizes).take(words.indices).flatten().to_numpy()
        table = np.concatenate([found, np.frombuffer(b"".join(more), "<u4")])
        before = np.append(0, np.cumsum(sizes[words.indices.to_numpy()]))
        bounds = before[np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy()))]
        sizes = np.append(np.diff(bounds), [len(m) // 4 for m in more])
        end = len(chunks.dictionary)
        stops = np.cumsum(pc.list_value_length(lists).to_numpy())
        which = np.insert(
            chunks.indices.to_numpy(),
            np.append(stops[marked], stops),
            np.append(end + 1 + np.arange(len(whole)), np.full(len(stops), end)),
        )
        if not len(table) or table.max() < 1 << 16:
            table = table.astype("<u2")
        flat = _rows(table, sizes).take(pa.array(which)).flatten().to_numpy()
        last = stops + np.arange(1, len(stops) + 1) + np.cumsum(marked)
        return flat, np.append(0, np.cumsum(sizes[which]))[np.append(0, last)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids (unsigned 32 bit, little-endian) of each text, with the end id."""
        flat, ends = self.flat(texts)
        raw, ends = flat.astype("<u4").tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def check(self, probe: str) -> None:
        if self.encode(pa.array([probe]))[0][:-4] != self._ids([probe])[0]:
            raise ValueError("the ids of a chunk of text depend on what is around it")


def _rows(values: np.ndarray, sizes: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pa.array(values))


@lru_cache(maxsize=1)
def _encoder(model: str, end_id: int) -> Encoder:
    return Encoder(model, end_id)


def _slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _tokenizer(sent, end_id: int, width: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, end_id)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        seen, own = np.zeros(width, np.int64), 0
        for batch in _slices(batches, 2048):
            docs, texts = batch.columns
            flat, ends = encoder.flat(texts)
            n = np.diff(ends)
            rest = n % width
            nth = np.empty(len(n), np.int64)
            for k, r in enumerate(rest.tolist()):
                nth[k] = seen[r]
                seen[r] += 1
            before = own + np.cumsum(n // width) - n // width
            own += int((n // width).sum())
            yield pa.RecordBatch.from_arrays(
                [
                    docs.cast(pa.int64()),
                    pa.array(np.full(len(n), task), pa.int32()),
                    pa.array(rest, pa.int32()),
                    pa.array(nth),
                    pa.array(before),
                    pa.array(n),
                    pa.array(
                        [_narrow(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)],
                        pa.binary(),
                    ),
                ],
                schema=schema,
            )

    return run


def _narrow(ids: np.ndarray) -> bytes:
    """Half the bytes, where all ids are below 65536; a leading byte tells."""
    small = ids.itemsize == 2 or ids.max() < 1 << 16
    return (b"2" + ids.astype("<u2", copy=False).tobytes()) if small else b"4" + ids.tobytes()


def _widened(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if stored[:1] == b"2" else "<u4", offset=1).astype("<u4")


def tokens(
    docs: DataFrame, tokenizer: str, end_id: int, width: int = WIDTH,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One stored row per document: its ids, and where it stands among the task's rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    _encoder(model, end_id).check("It's  soé\ńx   A1.\t#don't <|endoftext|>\x0b\x1c ok")
    sent = spark.sparkContext.broadcast(model)
    schema = to_arrow_schema(StructType.fromDDL(TOKENS))
    read = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return written(read.mapInArrow(_tokenizer(sent, end_id, width, schema), TOKENS), "tokens")


# The plan, from the histogram alone.


@dataclass
class Plan:
    """Places of remainders by length and rank. ``key`` is RANKS * length + first rank."""

    width: int
    key: np.ndarray
    times: np.ndarray  # remainders of that length per sequence
    sequence: np.ndarray  # the first sequence
    offset: np.ndarray
    used: np.ndarray  # by length: ranks below are in combinations
    base: np.ndarray  # by length: place of the others, laid end to end
    first_laid: int  # sequence of place 0
    laid: int  # tokens laid end to end

    @property
    def sequences(self) -> int:
        return self.first_laid + self.laid // self.width + (self.laid % self.width).bit_count()

    def bounds(self, start: int, end: int) -> list[int]:
        """Cuts of the places from start to end, both included."""
        last = self.laid // self.width * self.width
        cuts = list(range(start // self.width * self.width + self.width, min(end, last + 1), self.width))
        at, rest = last, self.laid - last
        while rest:
            at += 1 << rest.bit_length() - 1
            rest -= 1 << rest.bit_length() - 1
            if start < at < end:
                cuts.append(at)
        return [start, *cuts, end]

    def laid_at(self, place: int) -> tuple[int, int]:
        """Sequence and offset of a place."""
        last = self.laid // self.width * self.width
        if place < last:
            return self.first_laid + place // self.width, place % self.width
        sequence, at, rest = self.first_laid + last // self.width, last, self.laid - last
        while place >= at + (size := 1 << rest.bit_length() - 1):
            sequence, at, rest = sequence + 1, at + size, rest - size
        return sequence, place - at

    def pieces(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the remainder of that length and rank."""
        if not rest:
            return []
        if rank < self.used[rest]:
            k = int(np.searchsorted(self.key, RANKS * rest + rank, "right")) - 1
            j, times = rank - int(self.key[k]) % RANKS, int(self.times[k])
            return [(0, rest, int(self.sequence[k]) + j // times, int(self.offset[k]) + j % times * rest)]
        start = int(self.base[rest]) + (rank - int(self.used[rest])) * rest
        cuts = self.bounds(start, start + rest)
        return [(a - start, b - a, *self.laid_at(a)) for a, b in zip(cuts, cuts[1:], strict=False)]


class Combinations:
    """Columns of the least squares problem: up to three (length, times) each."""

    def __init__(self, width: int, counts: np.ndarray):
        self.width, self.counts = width, counts
        self.have = np.flatnonzero(counts)
        self.seen: set[tuple] = set()
        self.length, self.times = np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)

    def _pairs(self, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per sum, the greatest gain of two lengths and the smaller of the two."""
        best, which = np.full(self.width + 1, -np.inf), np.zeros(self.width + 1, np.int64)
        for b in self.have[self.have <= self.width // 2].tolist():
            new = gain[b] + gain[b : self.width + 1 - b]
            better = new > best[2 * b :]
            best[2 * b :][better] = new[better]
            which[2 * b :][better] = b
        return best, which

    def extend(self, gain: np.ndarray) -> bool:
        """For each length, the combination with it that gains most; False if none is new."""
        w = self.width
        priced = np.full(w + 1, -np.inf)
        priced[self.have] = gain[self.have]
        pair, smaller = self._pairs(priced)
        single = priced.copy()
        single[0] = pair[0] = 0.0
        one = single >= pair
        best = np.where(one, single, pair)
        new = []
        for a in self.have.tolist():
            times = np.arange(1, min(w // a, int(self.counts[a])) + 1)
            value = times * priced[a] + best[w - times * a]
            m = int(times[np.argmax(value)])
            rest = w - m * a
            if not value[m - 1] > 1e-9:
                continue
            parts = {a: m}
            for length in () if not rest else (rest,) if one[rest] else (
                int(smaller[rest]), rest - int(smaller[rest])
            ):
                parts[length] = parts.get(length, 0) + 1
            column = tuple(sorted(parts.items(), reverse=True))
            if column not in self.seen and all(self.counts[n] >= m for n, m in column):
                self.seen.add(column)
                new.append(column)
        if new:
            padded = np.array([[*c, *[(0, 0)] * (3 - len(c))] for c in new], np.int64)
            self.length = np.concatenate([self.length, padded[:, :, 0]])
            self.times = np.concatenate([self.times, padded[:, :, 1]])
        return bool(new)

    def product(self, x: np.ndarray) -> np.ndarray:
        weights = (self.times * x[:, None]).ravel()
        return np.bincount(self.length.ravel(), weights, self.width + 1)

    def gains(self, gain: np.ndarray) -> np.ndarray:
        return (gain[self.length] * self.times).sum(1)


def least_squares(
    counts: np.ndarray, width: int, rounds: int = 8, steps: int = 150
) -> tuple[Combinations, np.ndarray]:
    """Repetitions x >= 0 with columns * x near the counts, errors weighed by length.

    Accelerated projected gradient steps on the columns so far, then new columns.
    """
    columns = Combinations(width, counts)
    weight = np.arange(width + 1) / width
    x = np.zeros(0)
    for _ in range(rounds):
        if not columns.extend(weight * (counts - columns.product(x))):
            break
        x = np.append(x, np.zeros(len(columns.length) - len(x)))
        # Rows and columns scaled so that a unit step never overshoots (a bound of the norm).
        spread = columns.gains(weight * columns.product(np.ones(len(x))))
        pace = 1.0 / np.maximum(spread, 1e-12)
        y, momentum = x.copy(), 1.0
        for _ in range(steps):
            new = np.maximum(y + pace * columns.gains(weight * (counts - columns.product(y))), 0)
            grown = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
            y = new + (momentum - 1) / grown * (new - x)
            x, momentum = new, grown
    return columns, x


def plan(counts: np.ndarray, width: int = WIDTH) -> Plan:
    """``counts[r]``: remainders of length r, for r below ``width``."""
    counts = np.append(np.asarray(counts, np.int64), 0)
    counts[0] = 0
    columns, x = least_squares(counts, width)
    left, used = counts.copy(), np.zeros(width + 1, np.int64)
    entries: list[tuple[int, int, int, int]] = []
    sequence = 0

    def take(k: int, most: int) -> None:
        nonlocal sequence
        parts = [(int(n), int(m)) for n, m in zip(columns.length[k], columns.times[k], strict=True) if m]
        repeat = min([most, *(int(left[n]) // m for n, m in parts)])
        if repeat < 1:
            return
        at = 0
        for n, m in parts:
            entries.append((RANKS * n + int(used[n]), m, sequence, at))
            used[n] += m * repeat
            left[n] -= m * repeat
            at += n * m
        sequence += repeat

    by_size = np.argsort(-x, kind="stable").tolist()
    for k in by_size:
        take(k, round(x[k]))
    for k in by_size:
        take(k, int(left.max()))
    entries.sort()
    key, times, first, offset = np.array(entries, np.int64).reshape(-1, 4).T
    lengths = np.arange(width + 1)
    tokens_left = left * lengths
    base = np.cumsum(tokens_left) - tokens_left
    return Plan(width, key, times, first, offset, used, base, sequence, int(tokens_left.sum()))


# Places.


def _placer(sent, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planned: Plan = sent.value
        width = planned.width
        for batch in _slices(batches, 128):
            out: list[tuple] = []
            for doc, task, rest, nth, own, n, stored, base in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                ids = _widened(stored)
                whole = n // width
                mine = OWN + (task << OWN_PER_TASK) + own
                places = [(k * width, width, mine + k, 0) for k in range(whole)]
                for start, length, sequence, offset in planned.pieces(rest, base + nth):
                    places.append((whole * width + start, length, sequence, offset))
                for start, length, sequence, offset in places:
                    cut = ids[start : start + length].tobytes()
                    out.append((doc, start, length, cut, n, sequence, offset))
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, width: int = WIDTH,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (packed as unsigned 32-bit
    little-endian numbers), doc_tokens, sequence_id and offset.

    ``tokenizer`` is a file that every run of the driver can read; ``end_id`` ends every
    document. Each id lies in one piece; pieces of a sequence follow each other from offset 0
    and fill ``width`` tokens, but for a last few sequences whose lengths are powers of two.
    A null or empty text is the end id alone; rows of equal id are as many documents, a null
    id is kept; columns other than the two named are not read. Tokens are stored in the
    shared folder when this is called, as the histogram is needed for the plan; the places
    are lazy.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if width < 2 or width & (width - 1):
        raise ValueError("the width is a power of two")
    spark = docs.sparkSession
    stored = tokens(docs, tokenizer, end_id, width, doc_id, text)
    cells = stored.groupBy("task", "rest").agg(F.count("*").alias("rows"))
    counts = np.zeros(width, np.int64)
    for rest, rows in cells.groupBy("rest").agg(F.sum("rows")).collect():  # at most width rows
        counts[rest] = rows
    planned = plan(counts, width)
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(
        "task", "rest", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base")
    )
    ranked = stored.join(bases.hint("shuffle_hash"), ["task", "rest"]).select(
        *stored.columns, "base"
    )
    sent = spark.sparkContext.broadcast(planned)
    schema = to_arrow_schema(StructType.fromDDL(PIECES))
    return ranked.mapInArrow(_placer(sent, schema), PIECES)
