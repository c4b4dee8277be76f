"""Which fixed-width windows of all texts also occur earlier: routing by content.

A window of ``width`` tokens is routed by its *anchor*, the window's ``gram``-token piece
with the least hash. Equal windows have equal anchors, so all occurrences of a window meet
in the part of the hash space that owns the anchor, while neighbouring windows share their
anchor and travel as one *context*. Four passes over the shuffled documents:

1. anchors: which of them stand in more than one place at all?
2. contexts around those, by hash: which are the first with their content?
3. the tokens of contexts whose anchor has several different contents; the part finds the
   windows that occur earlier, by the operator's own index (``solve``). What pass 2 was told
   goes along and comes back, so contexts are ranked once
4. marks on the windows of every document, handed to ``finish``.

An anchor with very many different contents (the edge of a passage that very many documents
share) would make one part hold all of them. Its windows are dealt by their own hash
instead: a bucket sends each window once, with its first place, and hears whether another
bucket has an earlier one. Equal windows are told by 64-bit hashes there, as equal contents are.

Windows are judged on the input, so the result does not depend on the order of work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from patentloom.llm import exchange as X
from patentloom.llm.arrays import (
    BASE,
    U64,
    Texts,
    mix,
    powers,
    range_hashes,
    sliding_min,
    texts_of,
    INVERSE,
)
from patentloom.session import ship_package

RECORD = np.dtype(
    [("a", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("pos", "<i4"), ("at", "<i4")]
)
CODE = np.dtype([("at", "<i4"), ("code", "u1")])
BODY = np.dtype(RECORD.descr + [("len", "<i4")])
MASK = np.dtype([("at", "<i4"), ("mask", "<u8")])
PLACE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("pos", "<i4")])

ALONE, LATER, ASKED, SPREAD = 0, 1, 2, 3
BODIES, CODES, MASKS, BITS, PLACES = 0, 1, 2, 3, 4
#: Tokens that a part compares at once, but for an anchor's own: those are below ``HOT`` contents.
SLICE = 1 << 19
#: Different contents of an anchor from which its windows are dealt by their own hash.
HOT = 2_000


@dataclass(frozen=True)
class Windows:
    """``tokens`` of a bucket's texts and their first index per document.

    ``by_start``: of two places in one document the earlier one counts as earlier too;
    else only smaller document ids do. ``solve(records, tokens)`` gets the contexts of one
    anchor-hash part in order and returns a bit mask of repeated windows for each.
    """

    width: int
    gram: int
    by_start: bool
    dtype: np.dtype
    tokenise: Callable[[Texts], tuple[np.ndarray, np.ndarray]]
    solve: Callable[[np.ndarray, np.ndarray], np.ndarray]
    hot: int = HOT


@dataclass
class Contexts:
    a: np.ndarray  # anchor hash
    c: np.ndarray  # content hash
    first: np.ndarray  # first window
    last: np.ndarray  # last window
    doc: np.ndarray  # index of the document in the bucket
    tokens: np.ndarray
    starts: np.ndarray
    prefix: np.ndarray  # hashes, see ``prefix_hashes``

    def __len__(self) -> int:
        return len(self.a)


#: Window starts of one step; the hashes of a step stay in the processor's cache.
BLOCK = 1 << 15


def _hashed(tokens: np.ndarray, spec: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes, and for every window start the first token of the anchor.

    Grams are compared by 16 bits of their hashes, the first of equals counts: a block's
    windows need nothing from outside, and equal windows have their anchor at the same place.
    """
    n, width, gram = len(tokens), spec.width, spec.gram
    prefix = np.empty(n + 1, U64)
    prefix[0] = 0
    anchor = np.empty(n - width + 1, np.int32)
    most = min(BLOCK, n) + width
    base, inverse, places = powers(BASE, most), powers(INVERSE, most), np.arange(most, dtype=np.uint32)
    for at in range(0, len(anchor), BLOCK):
        end = min(at + BLOCK, len(anchor)) + width - 1
        own = tokens[at:end].astype(U64)
        own += U64(1)
        own *= base[: len(own)]
        sums = np.zeros(len(own) + 1, U64)
        np.cumsum(own, out=sums[1:])
        np.multiply(sums[1:], U64(pow(BASE, at, 1 << 64)), out=own)
        own += prefix[at]
        prefix[at + 1 : end + 1] = own
        grams = sums[gram:] - sums[:-gram]
        grams *= inverse[: len(grams)]
        grams >>= U64(48)
        keys = grams.astype(np.uint32)
        keys <<= np.uint32(16)
        keys |= places[: len(keys)]
        least = sliding_min(keys, width - gram + 1)
        least &= np.uint32(0xFFFF)
        anchor[at : at + len(least)] = least
        anchor[at : at + len(least)] += at
    return prefix, anchor


def contexts_of(texts: Texts, spec: Windows) -> Contexts:
    """Runs of windows with the same anchor position, in text order."""
    tokens, starts = spec.tokenise(texts)
    n, width = len(tokens), spec.width
    if n < width:
        none = np.zeros(0, np.int64)
        return Contexts(none.astype(U64), none.astype(U64), none, none, none, tokens, starts, none)
    prefix, anchor = _hashed(tokens, spec)
    long = np.flatnonzero(np.diff(starts) >= width)
    edges = np.zeros(len(anchor) + 1, bool)  # where an anchor or a document's windows begin or end
    np.not_equal(anchor[1:], anchor[:-1], out=edges[1:-1])
    edges[starts[long]] = True
    edges[starts[long + 1] - width + 1] = True
    first = np.flatnonzero(edges)
    last = np.append(first[1:], len(anchor)) - 1
    doc = np.searchsorted(starts, first, "right") - 1
    inside = first + width <= starts[doc + 1] if len(long) else np.zeros(len(first), bool)
    first, last, doc = first[inside], last[inside], doc[inside]
    content = range_hashes(prefix, first, last + width)
    content = mix(content + (last - first).astype(U64) * U64(0xD6E8FEB86659FD93))
    at = anchor[first].astype(np.int64)
    grams = mix(range_hashes(prefix, at, at + spec.gram))
    return Contexts(grams, content, first, last, doc, tokens, starts, prefix)


@dataclass
class Classes:
    """Contexts of a bucket with equal anchor and content; the first stands for all."""

    rep: np.ndarray  # per class: index of its first context
    of: np.ndarray  # per context: its class

    @classmethod
    def among(cls, found: Contexts) -> Classes:
        key = mix(found.a ^ mix(found.c))
        _, rep, of = np.unique(key, return_index=True, return_inverse=True)
        return cls(rep, of)


def _anchors(found: Contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(found.a, return_inverse=True, return_counts=True)


def _records(found: Contexts, texts: Texts, at: np.ndarray, dtype=RECORD) -> np.ndarray:
    out = np.zeros(len(at), dtype)
    out["a"], out["c"], out["at"] = found.a[at], found.c[at], at
    out["doc"] = texts.ids[found.doc[at]]
    out["pos"] = found.first[at] - found.starts[found.doc[at]]
    return out


def _ask(spec: Windows, parts: int):
    def run(table: pa.Table) -> pa.Table:
        found = contexts_of(texts_of(table), spec)
        if not len(found):
            return X.empty()
        deal = X.Deal(_anchors(found)[0], parts)
        return deal.pack(deal.remainders(), X.bucket_of(table))

    return run


def _offer(spec: Windows, parts: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        texts = texts_of(table)
        found = contexts_of(texts, spec)
        if not len(found):
            return X.empty()
        anchors, of, counts = _anchors(found)
        again = X.Deal(anchors, parts).unpack_bits(replies) | (counts > 1)
        rep = Classes.among(found).rep
        rep = np.sort(rep[again[of[rep]]])
        return X.Deal(found.a[rep], parts).pack(_records(found, texts, rep), X.bucket_of(table))

    return run


def _rank(spec: Windows):
    def run(table: pa.Table) -> pa.Table:
        blobs = table["blob"].to_pylist()
        records = np.frombuffer(b"".join(blobs), RECORD)
        keys = (records["pos"], records["doc"]) if spec.by_start else (records["doc"],)
        order = np.lexsort((*keys, records["c"], records["a"]))
        r = records[order]
        n = len(r)
        new_a = np.append(True, r["a"][1:] != r["a"][:-1])
        new_c = new_a | np.append(True, r["c"][1:] != r["c"][:-1])
        head = np.maximum.accumulate(np.where(new_c, np.arange(n), 0))  # first of the class
        later = r["doc"] > r["doc"][head]
        if spec.by_start:
            later |= (r["doc"] == r["doc"][head]) & (r["pos"] > r["pos"][head])
        group = np.cumsum(new_a) - 1
        contents = np.bincount(group, weights=new_c)[group]
        codes = np.zeros(n, CODE)
        codes["at"][order] = r["at"]
        several = np.where(contents > spec.hot, SPREAD, np.where(contents > 1, ASKED, ALONE))
        codes["code"][order] = np.where(later, LATER, several)
        out, at = [], 0
        for blob in blobs:
            k = len(blob) // RECORD.itemsize
            said = codes[at : at + k]
            out.append(said[said["code"] != ALONE].tobytes())
            at += k
        kind = pa.array(np.full(len(out), CODES), pa.int32())
        return pa.table(
            [table["part"], table["bucket"], kind, pa.array(out, pa.binary())], schema=X.SCHEMA
        )

    return run


def _codes(replies: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(b for _, _, b in X.blobs_by(replies, CODES)), CODE)


def _bodies(spec: Windows, parts: int):
    """Tokens of contexts to compare, places of spread windows, and all codes handed on."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        codes = _codes(replies)
        if not len(codes):
            return X.empty()
        bucket = X.bucket_of(table)
        rows = [(bucket % parts, bucket, CODES, codes.tobytes())]
        at = np.sort(codes["at"][codes["code"] == ASKED]).astype(np.int64)
        spread = (codes["code"] == SPREAD).any()
        places = X.empty()
        if len(at) or spread:
            texts = texts_of(table)
            found = contexts_of(texts, spec)
        if len(at):
            records = _records(found, texts, at, BODY)
            ends = found.last[at] + spec.width
            records["len"] = ends - found.first[at]
            deal = X.Deal(found.a[at], parts)
            firsts, ends, kind = found.first[at].tolist(), ends.tolist(), np.dtype(spec.dtype)
            tokens = memoryview(np.ascontiguousarray(found.tokens.astype(kind, copy=False))).cast("B")
            size = kind.itemsize
            for part, a, b in zip(deal.parts, deal.cuts, deal.ends, strict=True):
                own = deal.order[a:b]
                body = b"".join([tokens[firsts[i] * size : ends[i] * size] for i in own.tolist()])
                head = np.array([len(own)], "<i4").tobytes()
                rows.append((int(part), bucket, BODIES, head + records[own].tobytes() + body))
        if spread:
            windows = Spread(texts, found, codes, spec)
            places = X.Deal(windows.hash, parts).pack(windows.places(), bucket, PLACES)
        asked = pa.table([list(c) for c in zip(*rows, strict=True)], schema=X.SCHEMA)
        return pa.concat_tables([asked, places])

    return run


def _windows_of(found: Contexts, at: np.ndarray) -> np.ndarray:
    """First tokens of all windows of contexts ``at``, in their order."""
    size = found.last[at] - found.first[at] + 1
    return np.arange(size.sum()) + np.repeat(found.first[at] - np.cumsum(size) + size, size)


class Spread:
    """The different windows of a bucket's spread contexts, and the first place of each."""

    def __init__(self, texts: Texts, found: Contexts, codes: np.ndarray, spec: Windows):
        at = np.sort(codes["at"][codes["code"] == SPREAD]).astype(np.int64)
        window = _windows_of(found, at)  # ascending, so the first of a hash is the earliest
        h = mix(range_hashes(found.prefix, window, window + spec.width))
        self.hash, first = np.unique(h, return_index=True)
        self.doc, self.pos = _place(texts, found, window[first])

    def places(self) -> np.ndarray:
        out = np.zeros(len(self.hash), PLACE)
        out["h"], out["doc"], out["pos"] = self.hash, self.doc, self.pos
        return out


def _place(texts: Texts, found: Contexts, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.searchsorted(found.starts, window, "right") - 1
    return texts.ids[doc], window - found.starts[doc]


def _earlier(spec: Windows):
    """One bit per window of a bucket: whether another bucket has an earlier one."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table["blob"].to_pylist()
        r = np.frombuffer(b"".join(blobs), PLACE)
        order = np.lexsort((r["pos"], r["doc"], r["h"]))
        s = r[order]
        new = np.append(True, s["h"][1:] != s["h"][:-1])
        head = s[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
        later = np.zeros(len(r), bool)
        later[order] = s["doc"] > head["doc"]
        if spec.by_start:
            later[order] |= (s["doc"] == head["doc"]) & (s["pos"] > head["pos"])
        out, at = [], 0
        for blob in blobs:
            n = len(blob) // PLACE.itemsize
            out.append(np.packbits(later[at : at + n]).tobytes())
            at += n
        kind = pa.array(np.full(len(out), BITS), pa.int32())
        return pa.table(
            [table["part"], table["bucket"], kind, pa.array(out, pa.binary())], schema=X.SCHEMA
        )

    return run


def _mark_spread(
    out: np.ndarray, texts: Texts, found: Contexts, at: np.ndarray, replies: pa.Table,
    spec: Windows, parts: int,
) -> None:
    """Marks the repeated windows of contexts ``at``, whose contents have been spread."""
    spread = Spread(texts, found, _codes(replies), spec)
    bits = replies.filter(pc.equal(replies["kind"], BITS))
    later = X.Deal(spread.hash, parts).unpack_bits(bits)
    window = _windows_of(found, at)
    k = np.searchsorted(spread.hash, mix(range_hashes(found.prefix, window, window + spec.width)))
    doc, pos = _place(texts, found, window)
    gone = later[k] | (doc > spread.doc[k])
    if spec.by_start:
        gone |= (doc == spread.doc[k]) & (pos > spread.pos[k])
    out[window[gone]] = True


def _slices(anchors: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole anchor groups with about ``most`` tokens each."""
    heads = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
    size = np.append(0, ends)[heads]
    first = np.flatnonzero(np.diff(size // most, prepend=-1))
    cuts = [*heads[first].tolist(), len(anchors)]
    yield from zip(cuts, cuts[1:], strict=False)


def _compare(spec: Windows):
    def run(table: pa.Table) -> pa.Table:
        buckets, records_of, tokens = table["bucket"].to_pylist(), [], []
        for blob in table["blob"].to_pylist():
            n = int(np.frombuffer(blob, "<i4", 1)[0])
            records_of.append(np.frombuffer(blob, BODY, n, 4))
            tokens.append(np.frombuffer(blob, spec.dtype, -1, 4 + n * BODY.itemsize))
        records, tokens = np.concatenate(records_of), np.concatenate(tokens)
        start = np.append(0, np.cumsum(records["len"]))
        order = np.lexsort((records["pos"], records["doc"], records["a"]))
        ends = np.cumsum(records["len"][order].astype(np.int64))
        marks = np.zeros(len(records), MASK)
        marks["at"] = records["at"]
        for a, b in _slices(records["a"][order], ends, SLICE):
            own = order[a:b]
            lengths = records["len"][own].astype(np.int64)
            shift = start[own] - np.append(0, np.cumsum(lengths))[:-1]
            place = np.arange(lengths.sum()) + np.repeat(shift, lengths)
            marks["mask"][own] = spec.solve(records[own], tokens[place])
        part = table["part"][0].as_py()
        sizes, rows, at = [len(r) for r in records_of], [], 0
        for bucket, n in zip(buckets, sizes, strict=True):
            own = marks[at : at + n]
            rows.append((part, bucket, MASKS, own[own["mask"] != 0].tobytes()))
            at += n
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=X.SCHEMA)

    return run


def _solved(spec: Windows):
    """Replies of a part to bodies and places; codes go back to their bucket as they are."""
    answer = {CODES: lambda own: own, BODIES: _compare(spec), PLACES: _earlier(spec)}

    def run(table: pa.Table) -> pa.Table:
        out = [X.empty()]
        for kind, reply in answer.items():
            own = table.filter(pc.equal(table["kind"], kind))
            if own.num_rows:
                out.append(reply(own).cast(X.SCHEMA))
        return pa.concat_tables(out)

    return run


def _marks(
    texts: Texts, found: Contexts, replies: pa.Table, spec: Windows, parts: int
) -> np.ndarray:
    """True for every token index at which a repeated window starts."""
    n = len(found.tokens)
    out = np.zeros(n, bool)
    if not len(found):
        return out
    classes = Classes.among(found)
    code = np.zeros(len(found), np.uint8)
    said = _codes(replies)
    code[said["at"]] = said["code"]
    mask = np.zeros(len(found), U64)
    got = np.frombuffer(b"".join(b for _, _, b in X.blobs_by(replies, MASKS)), MASK)
    mask[got["at"]] = got["mask"]
    rep = classes.rep[classes.of]
    ids = texts.ids[found.doc]
    later = ids > ids[rep]
    if spec.by_start:
        pos = found.first - found.starts[found.doc]
        later |= (ids == ids[rep]) & (pos > pos[rep])
    whole = later | (code[rep] == LATER)
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, found.first[whole], 1)
    np.add.at(edges, found.last[whole] + 1, -1)
    out |= np.cumsum(edges[:n]) > 0
    some = np.flatnonzero(~whole & (mask[rep] != 0))
    for bit in range(spec.width - spec.gram + 1):
        hit = some[(mask[rep[some]] >> U64(bit)) & U64(1) != 0]
        out[found.first[hit] + bit] = True
    spread = np.flatnonzero(~whole & (code[rep] == SPREAD))
    if len(spread):
        _mark_spread(out, texts, found, spread, replies, spec, parts)
    return out


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """Tokens inside any window that starts at a marked token."""
    total = np.cumsum(starts, dtype=np.int32)
    out = total > 0
    out[width:] = total[width:] > total[:-width]
    return out


def _finish(spec: Windows, parts: int, finish):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        texts = texts_of(table)
        found = contexts_of(texts, spec)
        return finish(texts, covered(_marks(texts, found, replies, spec, parts), spec.width), found)

    return run


def mark_repeats(
    docs: DataFrame,
    doc_id: str,
    text: str,
    spec: Windows,
    finish: Callable[[Texts, np.ndarray, Contexts], pa.Table],
    schema: str,
    bucket_bytes: int,
    tokens_per_byte: float,
) -> DataFrame:
    """Rows of ``finish(texts, covered tokens, contexts)`` for every bucket of documents."""
    ship_package(docs.sparkSession)
    size = X.total_bytes(docs, text)
    docs = X.bucketed(docs, doc_id, text, size // bucket_bytes + 1)
    density = 2 * tokens_per_byte / (spec.width - spec.gram + 2)
    parts = X.parts_for(docs.sparkSession, size * density)
    flags = X.seen_elsewhere(X.per_bucket(docs, _ask(spec, parts)))
    offered = X.with_replies(docs, flags, _offer(spec, parts))
    codes = offered.groupBy("part").applyInArrow(_rank(spec), X.PACKED)
    asked = X.with_replies(docs, codes, _bodies(spec, parts))
    said = asked.groupBy("part").applyInArrow(_solved(spec), X.PACKED)
    return X.with_replies(docs, said, _finish(spec, parts, finish), schema)
