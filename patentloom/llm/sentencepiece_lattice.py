"""SentencePiece encoding and decoding over a relational lattice.

Texts are normalised the model's way (a blank in front, blanks as U+2581) and cut into units
that no piece spans: at blanks, digits, and between letters and ASCII punctuation, as far as
the model has no piece across. The different units of the corpus are exploded into substrings
no longer than the longest piece, which meet the piece table in an equi-join; that gives the
edges of each unit's lattice. The edges are grouped by unit, and a fold (``aggregate``) finds
the path:

* ``unigram`` models: the Viterbi path, the greatest sum of scores;
* ``bpe`` models: merges of neighbours by greatest score, leftmost first. Their scores are
  merge ranks, so the Viterbi path is not what the library returns; the lattice is the same.

Documents are shuffled once, in compressed buckets. A bucket asks for each of its units once, packed
into one row per part of the unit space, so a very common unit costs a part one entry per
bucket. A part builds the lattices of its different units once, whatever the number of
buckets, and replies with their ids; the documents read the same shuffle again to look them
up. The piece table is the only thing broadcast, and its size is the model's.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.llm.arrays import byte_hashes, map_from, releasing
from patentloom.llm.exchange import total_bytes
from patentloom.session import ship_package

BLANK = "▁"
#: Characters of one piece only, if of any, are cut out of the units: they never merge.
CUTS = "\n\t\r0123456789"
#: Characters between which and letters units are cut, if the model has no piece across.
PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
ENCODED = "doc_id long, text string, ids array<int>"


@dataclass(frozen=True)
class Pieces:
    """A model's pieces by id. ``kind`` is ``bpe`` or ``unigram``."""

    kind: str
    names: tuple[str, ...]
    scores: tuple[float, ...]
    plain: tuple[bool, ...]  # neither control, unknown, unused nor byte pieces
    unknown: int

    @property
    def longest(self) -> int:
        return max((len(n) for n, ok in zip(self.names, self.plain, strict=True) if ok), default=1)

    @property
    def cuts(self) -> str:
        own = (n for n, ok in zip(self.names, self.plain, strict=True) if ok and len(n) > 1)
        many = set("".join(own))
        return "".join(c for c in CUTS if c not in many)


def load(path: str, kind: str = "bpe") -> Pieces:
    """Pieces of a SentencePiece model file. It must add a blank in front, keep all blanks
    and leave characters as they are, as the public models with byte pieces do."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "a  bＡ"
    if model.decode(model.encode(probe)) != probe:
        raise ValueError(f"{path} changes texts before it encodes them")
    ids = range(model.get_piece_size())
    return Pieces(
        kind,
        tuple(model.id_to_piece(i) for i in ids),
        tuple(model.get_score(i) for i in ids),
        tuple(
            not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
            for i in ids
        ),
        model.unk_id(),
    )


def _class(characters: Iterable[str]) -> str:
    return "".join(f"\\U{ord(c):08x}" for c in sorted(characters))


def marks(names: Iterable[str]) -> set[str]:
    """Punctuation, and whatever pieces join to it; nothing if that includes letters."""
    found = set(PUNCTUATION)
    joined = {frozenset(pair) for n in names for pair in zip(n, n[1:], strict=False)}
    while more := set().union(*(pair for pair in joined if pair & found)) - found:
        found |= more
    return set() if any(c.isalpha() for c in found) else found


def _classes(pieces: Pieces) -> tuple[str, str]:
    """Characters that are units of their own, and those that are cut from letters."""
    own = [n for n, ok in zip(pieces.names, pieces.plain, strict=True) if ok]
    for name in own:
        if BLANK in name.lstrip(BLANK):
            raise ValueError(f"piece {name!r} has a blank behind other characters")
    return _class(pieces.cuts), _class(marks(n.lstrip(BLANK) for n in own) - set(pieces.cuts))


def unit_pattern(pieces: Pieces) -> str:
    """A pattern of units; every normalised text is a sequence of its matches."""
    cut, mark = _classes(pieces)
    return "|".join(
        [
            *([f"[{cut}]"] if cut else []),
            *([f"{BLANK}*[{mark}]+"] if mark else []),
            f"{BLANK}*[^{BLANK}{cut}{mark}]+",
            f"{BLANK}+",
        ]
    )


# The path of one unit, outside Spark expressions: long units, and units without edges.


def merged_by_rank(unit: str, score_of: dict[str, float]) -> list[str]:
    """Merges by greatest score, leftmost first, with a heap over a linked list."""
    n = len(unit)
    end = list(range(1, n + 1))  # end of the symbol that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap: list[tuple[float, int, int, int]] = []

    def offer(start: int) -> None:
        if start >= 0 and end[start] < n:
            stop = end[end[start]]
            score = score_of.get(unit[start:stop])
            if score is not None:
                heapq.heappush(heap, (-score, start, end[start], stop))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if end[start] != middle or middle >= n or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
        offer(before[start])
        offer(start)
    out, i = [], 0
    while i < n:
        out.append(unit[i : end[i]])
        i = end[i]
    return out


def best_path(unit: str, score_of: dict[str, float], longest: int, unknown: float) -> list[str]:
    """The Viterbi path; a character outside the table costs ``unknown``."""
    best, back = [0.0] + [-np.inf] * len(unit), [0] * (len(unit) + 1)
    for j in range(1, len(unit) + 1):
        for i in range(max(0, j - longest), j):
            score = score_of.get(unit[i:j], unknown if j == i + 1 else None)
            if score is not None and best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, i
    out, j = [], len(unit)
    while j:
        out.append(unit[back[j] : j])
        j = back[j]
    return out[::-1]


def unknown_score(pieces: Pieces) -> float:
    """As the library does: ten below the least score."""
    own = [s for s, ok in zip(pieces.scores, pieces.plain, strict=True) if ok]
    return min(own, default=0.0) - 10.0


# The same path as a fold of Spark expressions over a unit's edges.


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _inside(start: Column, end: Column) -> Column:
    """The bits of all places between two."""
    return _bit(end) - _bit(start + 1)


def _folded_merges(unit: Column, keys: Column) -> Column:
    """Pieces by merges; an edge of the lattice is a number: 4096 * rank + 64 * start + end.

    The state is a bit for each place where a symbol begins or ends. An edge can be merged
    while both its ends are such places and one more lies between; of those the least
    number, by rank and then from the left, is next. Below 0 there are no more.
    """

    def edge(key: Column) -> Column:
        start, end = F.call_function("div", key, F.lit(64)) % 64, key % 64
        return F.struct(
            _bit(start).bitwiseOR(_bit(end)).alias("ends"), _inside(start, end).alias("inside")
        )

    def merged(edges: Column) -> Column:
        def step(places: Column, _: Column) -> Column:
            def ready(e: Column) -> Column:
                joined = places.bitwiseAND(e["ends"]) == e["ends"]
                return joined & (F.bit_count(places.bitwiseAND(e["inside"])) == 1)

            def without(gone: Column) -> Column:
                return F.coalesce(
                    places.bitwiseAND(F.bitwise_not(gone)), F.lit(-1).cast("long") - places
                )

            least = F.get(F.filter(edges, ready), 0)["inside"]
            return F.when(places < 0, places).otherwise(_bind(least, without))

        # No more merges than characters or edges; one more step may find that none is left.
        steps = F.sequence(F.lit(1), F.least(F.length(unit), F.size(edges)))
        return F.aggregate(steps, _bit(F.length(unit) + 1) - 1, step)

    def bounds(places: Column) -> Column:
        own = F.when(places < 0, F.lit(-1).cast("long") - places).otherwise(places)
        every = F.sequence(F.lit(0), F.length(unit))
        return _bind(own, lambda m: F.filter(every, lambda i: m.bitwiseAND(_bit(i)) != 0))

    return _cut(unit, _bind(_bind(F.transform(F.sort_array(keys), edge), merged), bounds))


def _folded_path(unit: Column, edges: Column, longest: int, unknown: float) -> Column:
    """Pieces by Viterbi; the state holds, per position, the best score and where it came from."""
    length = F.length(unit)
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back")))

    def step(state: Column, end: Column) -> Column:
        def edge(size: Column) -> Column:
            begin = end - size
            own = F.try_element_at(edges, begin * 64 + size)
            own = F.coalesce(own, F.when(size == 1, F.lit(unknown)))
            return F.struct(
                (F.get(state, begin)["score"] + own).alias("score"), (-begin).alias("at")
            )

        sizes = F.sequence(F.lit(1), F.least(end, F.lit(longest)))
        best = F.array_max(F.transform(sizes, edge))
        return _bind(
            best,
            lambda b: F.concat(
                state, F.array(F.struct(b["score"].alias("score"), (-b["at"]).alias("back")))
            ),
        )

    state = F.aggregate(F.sequence(F.lit(1), length), start, step)

    def walk(path: Column, _: Column) -> Column:
        head = F.get(path, 0)
        return F.when(head == 0, path).otherwise(
            F.concat(F.array(F.get(state_of, head)["back"]), path)
        )

    state_of = state
    bounds = F.aggregate(F.sequence(F.lit(1), length), F.array(length), walk)
    return _cut(unit, bounds)


def _cut(unit: Column, bounds: Column) -> Column:
    return _bind(
        bounds,
        lambda b: F.transform(
            F.sequence(F.lit(0), F.size(b) - 2),
            lambda j: F.substr(unit, F.get(b, j) + 1, F.get(b, j + 1) - F.get(b, j)),
        ),
    )


def _columns(pieces: Pieces) -> tuple:
    return pieces.names, pieces.scores, pieces.plain


def lattice_paths(units: DataFrame, pieces: Pieces, keys: tuple[str, ...] = ("unit",)) -> DataFrame:
    """``keys`` (the last is the unit) and ``pieces``, for units that have an edge at all.

    Units are different from each other and shorter than 64 characters."""
    own = [(n, v) for n, v, ok in zip(*_columns(pieces), strict=True) if ok]
    rank = {v: i for i, v in enumerate(sorted({v for _, v in own}, reverse=True))}
    table = units.sparkSession.createDataFrame(
        pa.table(
            {
                "piece": [n for n, _ in own],
                "score": pa.array([v for _, v in own], pa.float64()),
                "rank": pa.array([rank[v] for _, v in own], pa.int32()),
            }
        )
    )
    least = 2 if pieces.kind == "bpe" else 1
    unit, longest = F.col("unit"), pieces.longest
    starts = units.where(F.length(unit) >= least).select(
        *keys, F.explode(F.sequence(F.lit(0), F.length(unit) - least)).alias("start")
    )
    size = F.least(F.lit(longest), F.length(unit) - F.col("start"))
    spans = starts.select(
        *keys, "start", F.explode(F.sequence(F.lit(least), size)).alias("size")
    ).withColumn("piece", F.substr(unit, F.col("start") + 1, F.col("size")))
    edges = spans.join(F.broadcast(table), "piece")
    if pieces.kind == "bpe":
        end = F.col("start") + F.col("size")
        key = F.col("rank").cast("long") * 4096 + F.col("start") * 64 + end
        grouped = edges.groupBy(*keys).agg(F.collect_list(key).alias("edges"))

        def path(own: Column) -> Column:
            return _folded_merges(unit, own)

    else:
        edge = F.struct(F.col("start") * 64 + F.col("size"), F.col("score"))
        grouped = edges.groupBy(*keys).agg(F.map_from_entries(F.collect_list(edge)).alias("edges"))

        def path(own: Column) -> Column:
            return _folded_path(unit, own, longest, unknown_score(pieces))

    # Bound, or the optimiser would build the edges anew for every look-up in the fold.
    return grouped.select(*keys, _bind(F.col("edges"), path).alias("pieces"))


# Documents.


class Encoder:
    """Ids of units, from the paths of a bucket or, where there is none, found here."""

    def __init__(self, pieces: Pieces, longest_unit: int):
        self.pieces, self.longest_unit = pieces, longest_unit
        plain = [i for i, ok in enumerate(pieces.plain) if ok]
        self.id_of = {pieces.names[i]: i for i in plain}
        self.score_of = {pieces.names[i]: pieces.scores[i] for i in plain}
        names = {n: i for i, n in enumerate(pieces.names)}
        self.byte = [names.get(f"<0x{b:02X}>", pieces.unknown) for b in range(256)]
        self.unknown = unknown_score(pieces)
        pattern = unit_pattern(pieces)
        self.find = re.compile(pattern).findall
        # Arrow's library of patterns writes characters in its own way.
        pattern, cut, mark = (
            re.sub(r"\\U([0-9a-f]{8})", r"\\x{\1}", p) for p in (pattern, *_classes(pieces))
        )
        self.cut, letter = f"({pattern})", f"[^{BLANK}{cut}{mark}]"
        #: Letters and then marks behind one blank, as most words are, and where that is cut.
        self.easy = f"^{BLANK}{letter}+" + (f"[{mark}]*$" if mark else "$")
        self.edge = f"({letter})([{mark}])" if mark else None
        self.names = pa.array(list(self.id_of), pa.string())
        self.numbers = np.array(list(self.id_of.values()), np.int32)

    def ids(self, path: Iterable[str]) -> bytes:
        out = array("i")
        for piece in path:
            i = self.id_of.get(piece)
            if i is not None:
                out.append(i)
            else:
                out.extend(self.byte[b] for b in piece.encode())
        return out.tobytes()

    def path(self, unit: str) -> list[str]:
        if self.pieces.kind == "bpe":
            return merged_by_rank(unit, self.score_of)
        return best_path(unit, self.score_of, self.pieces.longest, self.unknown)

    def joined(self, units: list[str], known: dict[str, bytes]) -> bytes:
        """Ids of units in order; those that nobody asks for are found here."""
        parts = []
        for unit in units:
            ids = known.get(unit)
            if ids is None:
                ids = known[unit] = self.ids(self.path(unit))
            parts.append(ids)
        return b"".join(parts)

    def encode(self, text: str, known: dict[str, bytes]) -> np.ndarray:
        units = self.find(BLANK + text.replace(" ", BLANK)) if text else []
        return np.frombuffer(self.joined(units, known), "<i4")


def _rows(values: np.ndarray, sizes: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pa.array(values))


def _ends(lists: pa.Array) -> np.ndarray:
    return np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))


@dataclass
class Words:
    """Texts as lists of words, and the different words as lists of units."""

    units: pa.Array  # the different ones
    unit_of: pa.Array  # for all words in order
    unit_ends: np.ndarray  # of each word's units
    word_of: pa.Array  # for all texts in order
    ends: np.ndarray  # of each text's words

    @classmethod
    def split(cls, encoder: Encoder, texts: pa.Array) -> Words:
        """Texts cut at single blanks; a text with other blanks is one word, an empty text
        the empty word, which no other text holds."""
        full = texts.fill_null("")
        odd = pc.or_(
            pc.or_(pc.match_substring(full, "  "), pc.match_substring(full, BLANK)),
            pc.or_(pc.starts_with(full, " "), pc.ends_with(full, " ")),
        )
        lists = pc.split_pattern(pc.if_else(odd, "", full), " ")
        words, ends = lists.flatten().dictionary_encode(), _ends(lists)
        rest = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        word_of = words.indices.to_numpy().copy()
        word_of[ends[rest]] = len(words.dictionary) + np.arange(len(rest))
        spelt = pa.concat_arrays(
            [words.dictionary, pc.replace_substring(full.take(pa.array(rest)), " ", BLANK)]
        )
        # A word stands for its units behind a blank. Blanks have been replaced, so one may
        # stand between units.
        behind = pc.binary_join_element_wise(BLANK, spelt, "")
        behind = pc.if_else(pc.equal(spelt, ""), "", behind)
        easy = pc.match_substring_regex(behind, encoder.easy)
        plain, other = behind.filter(easy), behind.filter(pc.invert(easy))
        if encoder.edge:
            plain = pc.replace_substring_regex(plain, encoder.edge, r"\1 \2")
        other = pc.ascii_rtrim(pc.replace_substring_regex(other, encoder.cut, r"\1 "), " ")
        easy = easy.to_numpy(zero_copy_only=False)
        place = np.where(easy, np.cumsum(easy) - 1, len(plain) + np.cumsum(~easy) - 1)
        cut = pc.split_pattern(pa.concat_arrays([plain, other]).take(pa.array(place)), " ")
        units = cut.flatten().dictionary_encode()
        return cls(units.dictionary, units.indices, _ends(cut), pa.array(word_of), ends)

    def ids(self, values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
        """The ids of each text from those of the different units."""
        found = _rows(values, sizes).take(self.unit_of).flatten().to_numpy()
        before = np.append(0, np.cumsum(sizes[self.unit_of.to_numpy()]))[self.unit_ends]
        of_texts = _rows(found, np.diff(before)).take(self.word_of).flatten()
        after = np.append(0, np.cumsum(np.diff(before)[self.word_of.to_numpy()]))[self.ends]
        return pa.ListArray.from_arrays(pa.array(after.astype(np.int32)), of_texts)


#: The columns of a bucket are a few MB each: to map each anew took a fifth of the time. They
#: stay in the heap until a step ends that is ``releasing``.
HELD = 8 << 20


@lru_cache(maxsize=2)
def _kept_encoder(pieces: Pieces, longest_unit: int) -> Encoder:
    return Encoder(pieces, longest_unit)


def _encoder(pieces: Pieces, longest_unit: int) -> Encoder:
    map_from(HELD)
    return _kept_encoder(pieces, longest_unit)


PACKED = "bucket long, blob binary"
ASKS = "part int, bucket long, blob binary"
ASKED = pa.schema([("part", pa.int32()), ("bucket", pa.int64()), ("blob", pa.binary())])
#: Between units in a packed row: blanks have been replaced in them.
BETWEEN = " "
ZSTD = pa.Codec("zstd", compression_level=3)


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + ZSTD.compress(raw, asbytes=True)


def _restored(stored: bytes) -> bytes:
    return ZSTD.decompress(stored[8:], int.from_bytes(stored[:8], "little"), asbytes=True)


def _packer(bucket_bytes: int):
    """Rows of a task in buckets of about that size, each one compressed row."""

    def packed(bucket: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema) as writer:
            for batch in held:
                writer.write_batch(batch)
        blob = _squeezed(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket]), pa.array([blob], pa.binary())], names=["bucket", "blob"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bucket = (context.partitionId() if context else 0) << 32
        held: list[pa.RecordBatch] = []
        have = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            at = 0
            for i, n in enumerate(sizes):
                if have and have + n > bucket_bytes:
                    yield packed(bucket, [*held, batch.slice(at, i - at)])
                    held, have, at, bucket = [], 0, i, bucket + 1
                have += n
            held.append(batch.slice(at))
        if any(batch.num_rows for batch in held):
            yield packed(bucket, held)

    return run


def _bucket(blob: bytes) -> tuple[pa.Array, pa.Array]:
    """Ids and texts of a packed row."""
    with pa.ipc.open_stream(_restored(blob)) as reader:
        table = reader.read_all()
    return tuple(pa.concat_arrays(c.chunks) for c in table.columns)


def _letters(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and where each begins and the last ends."""
    _, ends, data = units.cast(pa.large_string()).buffers()
    ends = np.frombuffer(ends, np.int64, len(units) + 1, units.offset * 8) if len(units) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


class Dealt:
    """The different units of a bucket that ask for a path, in the order of parts."""

    def __init__(self, encoder: Encoder, units: pa.Array, parts: int):
        units = pa.concat_arrays([units])
        lengths = pc.utf8_length(units).to_numpy()
        asks = (lengths > 1) & (lengths <= encoder.longest_unit)
        data, ends = _letters(units)
        part = byte_hashes(data, ends[:-1], ends[1:]) % np.uint64(parts)
        own = np.flatnonzero(asks)
        self.order = own[np.argsort(part[own], kind="stable")]
        self.rest = np.flatnonzero(~asks)
        dealt = part[self.order].astype(np.int64)
        first = np.flatnonzero(np.diff(dealt, prepend=-1))
        self.parts = dealt[first].tolist()
        self.cuts = [*first.tolist(), len(dealt)]

    def blobs(self, units: pa.Array) -> list[bytes]:
        """Units of each part, a blank between."""
        data, ends = _letters(pc.binary_join_element_wise(units.take(pa.array(self.order)), "", BETWEEN))
        at = ends[self.cuts].tolist()
        raw = data.tobytes()
        return [raw[a : b - 1] for a, b in zip(at, at[1:], strict=False)]


def _asker(sent, longest_unit: int, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, longest_unit)
        for batch in batches:
            for bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                units = Words.split(encoder, _bucket(blob)[1]).units
                dealt = Dealt(encoder, units, parts)
                blobs = [_squeezed(b) for b in dealt.blobs(units)]
                columns = [dealt.parts, [bucket] * len(blobs), blobs]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, ASKED, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=ASKED)

    return run


def _asked_units(asked: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The units of all rows, and where those of a row begin."""
    raw = [_restored(blob) for blob in asked["blob"].to_pylist()]
    lists = pc.split_pattern(pa.array(raw, pa.binary()).cast(pa.string()), BETWEEN)
    return lists.flatten(), _ends(lists)


def _different(asked: pa.Table) -> pa.Table:
    """The different units that a part is asked for."""
    units = pc.unique(_asked_units(asked)[0])
    part = pa.array(np.full(len(units), asked["part"][0].as_py(), np.int32))
    number = pa.array(np.arange(len(units), dtype=np.int32))
    return pa.table({"of": part, "number": number, "unit": units})


def _piece_ids(encoder: Encoder, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces, and how many each has: one, or as many as bytes if it is unknown."""
    at = pc.index_in(pieces, value_set=encoder.names)
    if not at.null_count:
        return encoder.numbers[at.to_numpy()], np.ones(len(at), np.int64)
    unknown = pc.unique(pieces.filter(at.is_null()))
    more = [encoder.ids([piece]) for piece in unknown.to_pylist()]
    sizes = np.append(np.ones(len(encoder.names), np.int64), [len(m) // 4 for m in more])
    values = np.append(encoder.numbers, np.frombuffer(b"".join(more), "<i4"))
    place = pc.add(pc.index_in(pieces, value_set=unknown), len(encoder.names))
    at = pc.coalesce(at, place)
    return _rows(values, sizes).take(at).flatten().to_numpy(), sizes[at.to_numpy()]


def _answers(sent, longest_unit: int):
    """Ids of the units in the order asked for: their numbers, then all ids of the row."""

    def run(asked: pa.Table, paths: pa.Table) -> pa.Table:
        encoder = _encoder(sent.value, longest_unit)
        kind = "<u2" if len(encoder.pieces.names) <= 1 << 16 else "<i4"
        wanted, cuts = _asked_units(asked)
        paths = paths.select(["unit", "pieces"]).combine_chunks()
        units = pa.concat_arrays([pa.array([], pa.string()), *paths["unit"].chunks])
        pieces = pa.concat_arrays([pa.array([], pa.list_(pa.string())), *paths["pieces"].chunks])
        # A unit without edges is its characters.
        alone = pc.unique(wanted.filter(pc.invert(pc.is_in(wanted, value_set=units))))
        single = pa.array([list(unit) for unit in alone.to_pylist()], pa.list_(pa.string()))
        pieces = pa.concat_arrays([pieces, single])
        values, sizes = _piece_ids(encoder, pieces.flatten())
        sizes = np.diff(np.append(0, np.cumsum(sizes))[_ends(pieces)])
        at = pc.index_in(wanted, value_set=pa.concat_arrays([units, alone]))
        ids = _rows(values, sizes).take(at).flatten().to_numpy().astype(kind)
        sizes = sizes[at.to_numpy()]
        ends = np.append(0, np.cumsum(sizes))[cuts].tolist()
        small, cuts = sizes.astype(np.uint8), cuts.tolist()
        blobs = [
            _squeezed(small[cuts[k] : cuts[k + 1]].tobytes() + ids[ends[k] : ends[k + 1]].tobytes())
            for k in range(len(cuts) - 1)
        ]
        return asked.set_column(2, "blob", pa.array(blobs, pa.binary())).cast(ASKED)

    return run


def _replied(
    encoder: Encoder, units: pa.Array, dealt: Dealt, replies: dict[int, bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, and how many each has."""
    kind = "<u2" if len(encoder.pieces.names) <= 1 << 16 else "<i4"
    values, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
    for part, a, b in zip(dealt.parts, dealt.cuts, dealt.cuts[1:], strict=False):
        raw = _restored(replies[part])
        sizes.append(np.frombuffer(raw, np.uint8, b - a))
        values.append(np.frombuffer(raw, kind, offset=b - a).astype("<i4"))
    # What nobody asks for is found here: single characters, and long units.
    rest = units.take(pa.array(dealt.rest)).to_pylist()
    own = [encoder.ids(encoder.path(unit)) for unit in rest]
    values.append(np.frombuffer(b"".join(own), "<i4"))
    all_sizes = np.concatenate([*sizes, [len(i) // 4 for i in own]]).astype(np.int64)
    place = np.empty(len(units), np.int64)
    place[dealt.order] = np.arange(len(dealt.order))
    place[dealt.rest] = len(dealt.order) + np.arange(len(rest))
    found = _rows(np.concatenate(values), all_sizes).take(pa.array(place))
    return found.flatten().to_numpy(), all_sizes[place]


def _looked_up(sent, longest_unit: int, parts: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32()))]
    )

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        encoder = _encoder(sent.value, longest_unit)
        said = dict(zip(replies["part"].to_pylist(), replies["blob"].to_pylist(), strict=True))
        tables = [schema.empty_table()]
        for blob in docs["blob"].to_pylist():
            ids, texts = _bucket(blob)
            words = Words.split(encoder, texts)
            dealt = Dealt(encoder, words.units, parts)
            lists = words.ids(*_replied(encoder, words.units, dealt, said))
            if texts.null_count:
                lists = pc.if_else(texts.is_valid(), lists, None)
            tables.append(pa.table([ids, texts, lists], schema=schema))
        return pa.concat_tables(tables)

    return run


def encode(
    docs: DataFrame,
    pieces: Pieces,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = 4 << 20,
    longest_unit: int = 48,
) -> DataFrame:
    """Columns doc_id, text and ids (piece ids as the library returns them).

    A null text has null ids, an empty one none. Every row comes out, repeated rows and null
    ids too; other columns are not read, whatever their names. Units of more than
    ``longest_unit`` characters (below 64) find their path outside the fold, by the same
    rule in time proportional to their length, so unbroken texts of any length are encoded.
    The size of all texts is added up when this is called; the rest is lazy. A bucket holds
    ``bucket_bytes`` of text, or one longer text.
    """
    if not 1 < longest_unit < 64:
        raise ValueError("longest_unit is between 2 and 63")
    spark = docs.sparkSession
    ship_package(spark)
    size = total_bytes(docs, text)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(size // (bucket_bytes // 2) + 1, width)
    sent = spark.sparkContext.broadcast(pieces)
    # A task per bucket and part: adaptive execution would join them by their few bytes.
    dealt = (
        docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
        .mapInArrow(releasing(_packer(bucket_bytes), HELD), PACKED)
        .repartition(max(size // bucket_bytes + 1, width), "bucket")
    )
    asked = dealt.mapInArrow(_asker(sent, longest_unit, parts), ASKS).repartition(parts, "part")
    units = asked.groupBy("part").applyInArrow(_different, "of int, number int, unit string")
    # Grouped by number first: numbers are cheaper to sort by than units, or than parts, of
    # which a task has few.
    paths = lattice_paths(units.repartition(parts, "of"), pieces, ("number", "of", "unit"))
    replies = (
        asked.groupBy("part")
        .cogroup(paths.groupBy("of"))
        .applyInArrow(_answers(sent, longest_unit), ASKS)
        .withColumnRenamed("bucket", "to")
    )
    return (
        dealt.groupBy("bucket")
        .cogroup(replies.groupBy("to"))
        .applyInArrow(_looked_up(sent, longest_unit, parts), ENCODED)
    )


def _decoder(sent, ids: str, to: str, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sent.value
        raw = []
        for name, ok in zip(pieces.names, pieces.plain, strict=True):
            if not ok and re.fullmatch("<0x[0-9A-F]{2}>", name):
                raw.append(bytes([int(name[3:5], 16)]))
            else:
                raw.append(name.replace(BLANK, " ").encode() if ok else b"")
        names_of = pa.array(raw, pa.large_binary())
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            lists = batch.column(batch.schema.get_field_index(ids))
            found = names_of.take(lists.flatten())
            _, ends, letters = found.buffers()
            ends = np.frombuffer(ends, np.int64)[found.offset : found.offset + len(found) + 1]
            letters = memoryview(letters) if letters is not None else b""
            out, at = [], 0
            for size in lists.value_lengths().to_pylist():
                if size is None:
                    out.append(None)
                    continue
                text = bytes(letters[ends[at] : ends[at + size]]) if size else b""
                at += size
                out.append(text.decode("utf-8", "replace")[size > 0 :])
            names = [f.name for f in schema if f.name != to]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns = [c.cast(schema.field(n).type) for n, c in zip(names, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string())], schema=schema)

    return run


def decode(encoded: DataFrame, pieces: Pieces, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` and the text its ids stand for, without the blank in front.

    Byte pieces are joined to characters; control pieces stand for nothing. Null ids give a
    null text. U+2581 in a text reads as a blank, as in the library. A column named as the
    result is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    plain = encoded.drop(to)
    out = plain.withColumn(to, F.lit(None).cast("string"))
    sent = encoded.sparkSession.sparkContext.broadcast(pieces)
    schema = to_arrow_schema(out.schema)
    return plain.mapInArrow(releasing(_decoder(sent, ids, to, schema), HELD), out.schema)
