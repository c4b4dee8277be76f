"""Suffix-array dedup: longest-previous-factor arrays over passages of bytes.

Bytes of a document that repeat 50 bytes of a document with a smaller id go. Passages that
may match meet in one part of the hash space (see ``windows``); the part sorts their
suffixes by rank doubling. For each suffix, the nearest suffixes before and after it in
that order whose document is smaller (previous and next smaller values) share the longest
prefixes with it among all earlier documents; the longer of the two is the longest previous
factor, and a window goes where that reaches the window's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from patentloom.llm.arrays import Texts, binary_array, id_array
from patentloom.llm.windows import Contexts, Windows, mark_repeats

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


#: Bytes of the first ranks: as many digits, the end of the data among them, as 64 bits hold.
FIRST = 7


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1 of numbers below 2**63; equal ones share a rank."""
    n = len(key)
    bits = n.bit_length()
    if not n or int(key.max()).bit_length() + bits > 63:
        order = np.argsort(key)
        ordered = key[order]
    else:  # numbers and places in one are sorted faster than places by number
        both = np.sort((key << bits) | np.arange(n))
        order, ordered = both & ((1 << bits) - 1), both >> bits
    new = np.ones(n, np.int64)
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` bytes or more, by rank doubling.

    Beyond the end stands a rank below all others.
    """
    n = len(data)
    digits = np.zeros(n + FIRST, np.int64)
    digits[:n] = data
    digits[:n] += 1
    key = digits[:n].copy()
    for at in range(1, FIRST):
        key *= 257
        key += digits[at : at + n]
    rank, have = _dense(key), FIRST
    while have < depth:
        key = rank << n.bit_length()
        key[:-have] |= rank[have:]
        rank = _dense(key)
        have *= 2
    return rank


def common_prefix(data: np.ndarray, i: np.ndarray, j: np.ndarray, depth: int) -> np.ndarray:
    """Longest common prefixes of suffixes i and j up to ``depth``, eight bytes at a time."""
    padded = np.append(data, np.zeros(depth + 8, np.uint8))
    blocks = np.ndarray(len(data) + depth + 1, "<u8", padded, strides=(1,))
    out = np.full(len(i), depth, np.int64)
    open_ = np.arange(len(i))
    for at in range(0, depth, 8):
        differ = blocks[i[open_] + at] ^ blocks[j[open_] + at]
        ended = differ != 0
        differ = differ[ended]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
        out[open_[ended]] = at + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
        open_ = open_[~ended]
        if not len(open_):
            break
    return np.minimum(np.minimum(out, depth), len(data) - np.maximum(i, j))


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest strictly smaller value before each, or -1."""
    at = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(at >= 0)
    while len(open_):
        open_ = open_[values[at[open_]] >= values[open_]]
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
    return at


def longest_previous_factors(
    data: np.ndarray, owner: np.ndarray, at: np.ndarray, depth: int
) -> np.ndarray:
    """For suffixes ``at``: longest prefix, of up to ``depth`` bytes, shared with one of a
    smaller owner."""
    order = at[np.argsort(suffix_ranks(data, depth)[at])]
    owners = owner[order]
    n = len(order)
    before = previous_smaller(owners)
    after = n - 1 - previous_smaller(owners[::-1])[::-1]
    best = np.zeros(n, np.int64)
    for near, ok in ((before, before >= 0), (after, after < n)):
        k = np.flatnonzero(ok)
        best[k] = np.maximum(best[k], common_prefix(data, order[k], order[near[k]], depth))
    out = np.zeros(len(data), np.int64)
    out[order] = best
    return out[at]


def _solver(width: int):
    def solve(records: np.ndarray, data: np.ndarray) -> np.ndarray:
        lengths = records["len"].astype(np.int64)
        start = np.append(0, np.cumsum(lengths))[:-1]
        windows = lengths - width + 1
        record = np.repeat(np.arange(len(records)), windows)
        nth = np.arange(len(record)) - np.repeat(np.cumsum(windows) - windows, windows)
        owner = np.repeat(records["doc"], lengths)
        factors = longest_previous_factors(data, owner, start[record] + nth, width)
        bits = (factors >= width).astype(np.uint64) << nth.astype(np.uint64)
        return np.add.reduceat(bits, np.cumsum(windows) - windows)

    return solve


def _tokenise(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    return texts.data, texts.offsets


def _finish(texts: Texts, gone: np.ndarray, found: Contexts) -> pa.Table:
    total = np.append(0, np.cumsum(gone))[texts.offsets]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    heads = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[heads] = gone[heads]  # a run does not go on from one document into the next
    spans = np.append(0, np.cumsum(begins))[texts.offsets]
    sizes = np.diff(texts.offsets)
    return pa.table(
        {
            "doc_id": id_array(texts.ids),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(np.diff(total), pa.int64()),
            "n_spans": pa.array(np.diff(spans), pa.int64()),
            "kept": binary_array(texts.data[~gone], texts.offsets - total),
        }
    )


def remove_repeated_bytes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 50,
    gram: int = 19,
    bucket_bytes: int = 1 << 20,
) -> DataFrame:
    """Columns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary).

    A byte goes when a string of ``width`` bytes that covers it also starts in a document
    with a smaller id. Matches stay within documents and are judged on the input. One row
    comes out per row that goes in: null and empty texts have no bytes, a null id sorts last,
    rows with equal ids do not remove each other's bytes. Texts may be of any length. What
    is kept need not be valid UTF-8. Other columns are not read, whatever their names.
    ``width - gram`` is below 64: a context has at most that many windows and one more.
    """
    spec = Windows(width, gram, False, np.dtype("u1"), _tokenise, _solver(width))
    return mark_repeats(docs, doc_id, text, spec, _finish, RESULT, bucket_bytes, 1.0)
