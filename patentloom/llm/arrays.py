"""Vectorised hashing and text columns as numpy arrays."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Stands for a null id: sorts after all others.
NULL_ID = np.iinfo(np.int64).max

# Python workers outlive their tasks: memory of a finished group goes back to the system. The
# C library would otherwise keep freed arrays of up to 32 MB for later (M_MMAP_THRESHOLD).
pa.set_memory_pool(pa.system_memory_pool())


def map_from(size: int) -> None:
    """Arrays from ``size`` bytes on are mapped and unmapped one by one."""
    try:
        ctypes.CDLL(None).mallopt(-3, size)
    except (AttributeError, OSError):
        pass


MAPPED = 1 << 20
map_from(MAPPED)


def release(size: int = MAPPED) -> None:
    """What freed arrays and objects have left in the heap goes back to the system.

    Arrays are mapped from ``size`` bytes on afterwards."""
    map_from(size)
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def releasing(run: Callable, size: int = MAPPED) -> Callable:
    """``run`` of batches, for a worker that then waits for its next task.

    Idle workers stay beside those at work, so an executor holds what all of them have kept.
    Not for steps of single groups: pages given back are costly to get again.
    """

    def of_batches(batches):
        yield from run(batches)
        release(size)

    return of_batches


_powers: dict[int, np.ndarray] = {}
#: Powers that a worker keeps; the others are made when they are needed.
KEPT_POWERS = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        filled = np.full(max(n, 1 << 16), base, U64)
        filled[0] = 1
        have = np.cumprod(filled, dtype=U64)
        _powers[base] = have[:KEPT_POWERS].copy()
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


def prefix_hashes(tokens: np.ndarray) -> np.ndarray:
    """Prefix sums of tokens times powers; see ``range_hashes``."""
    out = np.empty(len(tokens) + 1, U64)
    out[0] = 0
    np.cumsum(tokens * powers(BASE, len(tokens)), out=out[1:], dtype=U64)
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``tokens[start:end]``, the same wherever the tokens stand."""
    if 4 * len(start) > len(prefix):
        return (prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start]
    low = powers(INVERSE, 1 << 16)[start & 0xFFFF]
    high = powers(pow(INVERSE, 1 << 16, 1 << 64), (len(prefix) >> 16) + 1)[start >> 16]
    return (prefix[end] - prefix[start]) * (low * high)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


@dataclass
class Texts:
    """Documents of a group in order of (id, text), their bytes in one array."""

    ids: np.ndarray  # int64, NULL_ID for null
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    def __len__(self) -> int:
        return len(self.ids)


def texts_of(table: pa.Table) -> Texts:
    """Columns ``doc`` (long) and ``text`` (binary) of a group; null texts are empty."""
    table = table.select(["doc", "text"]).combine_chunks()
    ids = table["doc"].fill_null(int(NULL_ID)).to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(ids) and (np.diff(ids[order]) == 0).any():
        texts = table["text"].fill_null(b"").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
    column = table["text"].fill_null(b"").take(pa.array(order)).cast(pa.large_binary())
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if (
        len(column)
    ) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(ids[order], raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


@dataclass
class Words:
    """Words of ``texts``: byte ranges, hashes, and the first word of each document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more than documents


BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def words_of(texts: Texts, lower: bool = False) -> Words:
    """Runs of bytes other than blank and 0x09-0x0D; ``lower`` lower-cases A-Z first."""
    data, n = texts.data, len(texts.data)
    word = ~BLANK[data]
    head = np.zeros(n + 1, bool)  # first bytes of documents
    head[texts.offsets] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | head[1:n]
    ends[:-1] &= ~word[1:] | head[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if lower:
        data = data.copy()
        data[(data >= 65) & (data <= 90)] += 32
    return Words(start, end, byte_hashes(data, start, end), np.searchsorted(start, texts.offsets))


#: Bytes of a range from which a library hash is cheaper than blocks of eight.
LONG = 64


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, mixed after every eight bytes.

    Ranges of up to eight bytes of one length never clash. Long ones have a hash of the
    library: sums of powers would give equal values for some words of 1,024 letters.
    """
    padded = np.append(data, np.zeros(8, np.uint8))
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = end - start
    out = mix(size.astype(U64) * U64(0xD6E8FEB86659FD93))
    rest = np.flatnonzero(size <= LONG)
    for at in range(0, LONG, 8):
        rest = rest[size[rest] > at]
        if not len(rest):
            break
        left = np.minimum(size[rest] - at, 8).astype(U64)
        block = blocks[start[rest] + at] & (U64(_MASK) >> (U64(64) - U64(8) * left))
        out[rest] = mix(out[rest] * U64(BASE) + block)
    raw = None
    for i in np.flatnonzero(size > LONG).tolist():
        raw = data.tobytes() if raw is None else raw
        digest = hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out
