"""Ordered lines: splitting them into parts and stitching records back together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentloom.functions.text import stripped
from patentloom.sinks.files import written
from patentloom.sources.text import LINE_ORDER, RECORD_ID, header_rule, opening_rule


def parts_of(lines: DataFrame, bytes_per_part: int) -> int:
    """Number of parts of about ``bytes_per_part`` bytes."""
    total = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    return max(1, -(-total // bytes_per_part))


def split_in_order(lines: DataFrame, parts: int) -> DataFrame:
    """The same lines in ``parts`` partitions that, read one after another, keep the
    input order. Written as text, partition ``i`` becomes part file ``i``.

    A line's part follows from the lines in the splits before its own and its place in the
    split, so no sample of the lines goes to the driver: the table of splits, one row each,
    is all that is broadcast. Places are held within their split's count, which keeps the
    order even if the two scans deal splits to tasks differently; a split that only one of
    them knows is an error.
    """
    split = ["file", "block"]
    per_split = lines.groupBy(*split).agg(F.min("line").alias("_first"), F.count("line").alias("_n"))
    every = Window.orderBy(*split)
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = per_split.select(
        *split,
        "_first",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )
    inside = F.least(F.greatest(F.col("line") - F.col("_first"), F.lit(0)), F.col("_n") - 1)
    part = F.call_function("div", (F.col("_before") + inside) * parts, F.col("_total"))
    unknown = F.raise_error(F.lit("lines were split differently in two scans")).cast("long")
    placed = lines.join(F.broadcast(splits), split, "left").select(
        *lines.columns, F.coalesce(part, unknown).cast("int").alias("_part")
    )
    dealt = placed.repartitionById(parts, F.col("_part"))
    return dealt.sortWithinPartitions(*LINE_ORDER).select(*lines.columns)


def stitch_lines(
    lines: DataFrame,
    has_header: bool = True,
    id_column: str = "patent_id",
    text_column: str = "summary_text",
    id_pattern: str = RECORD_ID,
) -> DataFrame:
    """Records from lines of parts that may be cut in the middle of a record.

    A quoted id and a tab at a line start open a record (``sources.text.opening_rule``),
    later lines continue it across part boundaries, whatever they start with. Numbering is done in two levels so that no task sees more than one
    split: openings are counted per split, a running total over the (few) splits
    gives each its first number, and lines are numbered inside their split. Both
    levels must see the same splits, which two scans need not agree on while a
    cluster grows or shrinks, so the lines are written out first.
    """
    opening = opening_rule(id_pattern)
    if has_header:
        lines = lines.where(~F.col("value").rlike(header_rule(id_column)))
    lines = written(lines.withColumn("opens", F.col("value").rlike(opening)), "lines")
    split = ["file", "block"]
    per_split = lines.groupBy(*split).agg(F.count_if("opens").alias("openings"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select(
        *split, F.coalesce(F.sum("openings").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*split).orderBy("line")
    numbered = lines.withColumn("opened", F.count_if("opens").over(inside)).join(offsets, split)
    records = (
        numbered.withColumn("record", F.col("offset") + F.col("opened"))
        .where(F.col("record") > 0)
        .groupBy("record")
        .agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER, "value"))).alias("lines"))
    )
    first = F.col("lines")[0]["value"]
    rest = F.transform(F.slice("lines", 2, F.size("lines")), lambda x: stripped(x["value"]))
    text = F.array_join(
        F.concat(F.array(stripped(F.regexp_extract(first, opening, 2))), rest), " "
    )
    stitched = records.select(
        F.regexp_extract(first, opening, 1).alias(id_column), stripped(text).alias(text_column)
    )
    return stitched.where(F.col(id_column) != "")
