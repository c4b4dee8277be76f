"""Packed exchanges between buckets of documents and parts of a hash space.

Operators that ask of every position of every text "does this value also stand elsewhere?"
would shuffle one row per position. Here a task handles a bucket of documents (a few MB of
text) at a time and sends, per part of the hash space, one row with the packed values of
that bucket; a part answers each bucket with one packed reply in the order of the question.
A value is sent at most once per bucket, so a value of very many rows costs a part no more
than one entry per bucket. Buckets and parts grow in number with the input, not in size.
All steps are lazy and in one plan, which reads the shuffle of the documents again instead
of shuffling them anew; lost executors only cost the lost tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom.llm.arrays import U64, mix

PACKED = "part int, bucket int, kind int, blob binary"
SCHEMA = pa.schema(
    [("part", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())]
)


def total_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def bucketed(docs: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """Columns ``bucket``, ``doc``, ``text`` (binary); copies and equal ids are spread."""
    return docs.select(
        F.pmod(F.xxhash64(doc_id, text), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(doc_id).cast("long").alias("doc"),
        F.col(text).cast("binary").alias("text"),
    )


def parts_for(spark: SparkSession, entries: float, per_part: int = 1 << 20) -> int:
    """Parts so that each gets about ``per_part`` entries, and no fewer than shuffle tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(entries // per_part) + 1)


class Deal:
    """How the values of one bucket are dealt to parts."""

    def __init__(self, keys: np.ndarray, parts: int):
        self.mixed = mix(keys)
        # Numbers of 16 bits are sorted by radix.
        part = (self.mixed % U64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int32)
        self.order = np.argsort(part, kind="stable")
        dealt = part[self.order].astype(np.int32)
        self.cuts = np.flatnonzero(np.diff(dealt, prepend=-1))
        self.parts = dealt[self.cuts]
        self.ends = np.append(self.cuts[1:], len(dealt))[: len(self.cuts)]

    def pack(self, values: np.ndarray, bucket: int, kind: int = 0) -> pa.Table:
        """One row per part with the raw bytes of its values."""
        values = np.ascontiguousarray(values[self.order])
        size = values.dtype.itemsize
        raw = values.tobytes()
        blobs = [raw[a * size : b * size] for a, b in zip(self.cuts, self.ends, strict=True)]
        n = len(blobs)
        return pa.table(
            [
                pa.array(self.parts, pa.int32()),
                pa.array(np.full(n, bucket), pa.int32()),
                pa.array(np.full(n, kind), pa.int32()),
                pa.array(blobs, pa.binary()),
            ],
            schema=SCHEMA,
        )

    def remainders(self) -> np.ndarray:
        """What tells values of one part apart: 32 bits besides the part's own."""
        return (self.mixed >> U64(32)).astype(np.uint32)

    def unpack_bits(self, replies: pa.Table) -> np.ndarray:
        """Bits of all parts' replies, in the order of the keys."""
        out = np.zeros(len(self.order), bool)
        place = {int(p): k for k, p in enumerate(self.parts)}
        for part, blob in zip(
            replies["part"].to_pylist(), replies["blob"].to_pylist(), strict=True
        ):
            k = place[part]
            at = self.order[self.cuts[k] : self.ends[k]]
            out[at] = np.unpackbits(np.frombuffer(blob, np.uint8), count=len(at)).astype(bool)
        return out


def bucket_of(table: pa.Table) -> int:
    return table["bucket"][0].as_py() if table.num_rows else 0


def _seen_twice(table: pa.Table) -> pa.Table:
    blobs = table["blob"].to_pylist()
    values = np.frombuffer(b"".join(blobs), np.uint32)
    order = np.argsort(values)
    again = values[order][1:] == values[order][:-1]
    twice = np.zeros(len(values), bool)
    twice[order[1:][again]] = True
    twice[order[:-1][again]] = True
    out, at = [], 0
    for blob in blobs:
        n = len(blob) // 4
        out.append(np.packbits(twice[at : at + n]).tobytes())
        at += n
    return table.set_column(3, "blob", pa.array(out, pa.binary())).cast(SCHEMA)


def seen_elsewhere(asked: DataFrame) -> DataFrame:
    """Replies of one bit per asked value: whether another bucket asked for it too.

    ``asked`` packs ``Deal.remainders`` of distinct values. A value is told apart by the part
    and 32 more bits, and parts grow with the input: a bit may be set for a value that is
    alone (one in thousands), never be missing. Callers check what they keep.
    """
    return asked.groupBy("part").applyInArrow(_seen_twice, PACKED)


def per_bucket(
    docs: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str = PACKED
) -> DataFrame:
    return docs.groupBy("bucket").applyInArrow(run, schema)


def with_replies(
    docs: DataFrame,
    replies: DataFrame,
    run: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str = PACKED,
) -> DataFrame:
    return (
        docs.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(run, schema)
    )


def empty() -> pa.Table:
    return SCHEMA.empty_table()


def blobs_by(table: pa.Table, kind: int | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(part, bucket, blob) of the rows of a kind."""
    for p, b, k, blob in zip(*(table[c].to_pylist() for c in SCHEMA.names), strict=True):
        if kind is None or k == kind:
            yield p, b, blob
