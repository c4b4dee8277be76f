"""Substring dedup with suffix automata of reference shards.

Words of a document that repeat 20 consecutive words from earlier in the corpus go. The
reference is cut into shards by content (see ``windows``): a shard is the set of different
passages around one anchor. Broadcasting every shard to every document would cost the
square of the corpus, so passages travel to the shard that can match them instead. There
they stream in corpus order through the shard's suffix automaton, which yields the
matching statistics (the longest suffix read so far that also occurs earlier), and are
then added to it. A shard holds each content once, however often it occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.llm.arrays import Texts, binary_array, id_array, words_of
from patentloom.llm.windows import Contexts, Windows, mark_repeats

RESULT = "doc_id long, n_words long, n_removed long, kept binary"


class SuffixAutomaton:
    """Automaton of all substrings of the added sequences."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, link: int, step: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.step.append(step)
        return len(self.size) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state for ``state`` + symbol alone, cut off from longer substrings."""
        target = self.step[state][symbol]
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._state(self.size[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = copy
        while state >= 0 and self.step[state].get(symbol) == target:
            self.step[state][symbol] = copy
            state = self.link[state]
        return copy

    def add(self, symbols: list[int]) -> None:
        last = 0
        for symbol in symbols:
            if symbol in self.step[last]:
                last = self._split(last, symbol)
                continue
            new = self._state(self.size[last] + 1, 0, {})
            state = last
            while state >= 0 and symbol not in self.step[state]:
                self.step[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, symbol)
            last = new

    def matching_statistics(self, symbols: list[int]) -> list[int]:
        """For each position the longest match that ends there."""
        out, state, length = [], 0, 0
        for symbol in symbols:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                length = self.size[state]
            following = self.step[state].get(symbol)
            if following is None:
                state, length = 0, 0
            else:
                state, length = following, length + 1
            out.append(length)
        return out


def _solver(width: int):
    def solve(records: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        masks = np.zeros(len(records), np.uint64)
        symbols = tokens.tolist()
        ends = np.cumsum(records["len"].astype(np.int64)).tolist()
        new = np.flatnonzero(records["a"][1:] != records["a"][:-1]) + 1
        begin = 0
        for shard in (*new.tolist(), len(ends)):
            automaton, waiting, place = SuffixAutomaton(), [], None
            for k in range(begin, shard):
                passage = symbols[ends[k] - int(records["len"][k]) : ends[k]]
                here = (records["doc"][k], records["pos"][k])
                if here != place:  # passages at one place are not earlier than each other
                    for earlier in waiting:
                        automaton.add(earlier)
                    waiting, place = [], here
                if k > begin:
                    bits = 0
                    matched = automaton.matching_statistics(passage)
                    for i, length in enumerate(matched[width - 1 :]):
                        bits |= (length >= width) << i
                    masks[k] = bits
                waiting.append(passage)
            begin = shard
        return masks

    return solve


def _tokenise(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts)
    return words.hash, words.first


def _finish(texts: Texts, gone: np.ndarray, found: Contexts) -> pa.Table:
    words = words_of(texts)
    kept = np.flatnonzero(~gone)
    start, size = words.start[kept], words.end[kept] - words.start[kept] + 1  # and one blank
    place = np.cumsum(size)
    source = np.arange(place[-1] if len(place) else 0) + np.repeat(start - place + size, size)
    data = np.append(texts.data, np.uint8(32))[source]
    if len(place):
        data[place - 1] = 32
    before = np.append(0, np.cumsum(~gone))[words.first]  # kept words before each document
    ends = np.append(0, place)[before]
    full = np.flatnonzero(np.diff(ends))  # documents that keep words lose their last blank
    solid = np.ones(len(data), bool)
    solid[ends[full + 1] - 1] = False
    lengths = np.diff(ends)
    lengths[full] -= 1
    removed = np.diff(words.first) - np.diff(before)
    return pa.table(
        {
            "doc_id": id_array(texts.ids),
            "n_words": pa.array(np.diff(words.first), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": binary_array(data[solid], np.append(0, np.cumsum(lengths))),
        }
    )


def remove_repeated_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 20,
    gram: int = 5,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """Columns doc_id, n_words, n_removed and kept (kept words joined by one blank).

    A word goes when a window of ``width`` words that covers it has the same words as one
    that starts earlier: in a document with a smaller id, or earlier in the same document.
    Words are runs of characters other than blank and U+0009 to U+000D, unchanged. One row
    comes out per row that goes in: null and empty texts have no words, a null id sorts last,
    and rows with equal ids count as one document by where their windows start (rows that
    are equal in full keep each other). Texts may be of any length. Other columns are not
    read, whatever their names.
    """
    spec = Windows(width, gram, True, np.dtype("<u8"), _tokenise, _solver(width))
    out = mark_repeats(docs, doc_id, text, spec, _finish, RESULT, bucket_bytes, 1 / 6)
    return out.withColumn("kept", F.col("kept").cast("string"))
