"""Line dedup by a segment-partition edit join, with DataFrame functions alone.

A line goes when an equal line, or one within ``edits`` edits, stands earlier in the corpus.
Equal lines are found by hash, so only one line of each content takes part in the join. Such
a line is cut into ``edits + 1`` segments: whatever the edits, one segment of the shorter
line stands unchanged in the longer one, at a place that the difference in length bounds.
Lines offer their own segments with their length, probe for those that shorter lines may
offer, and meet in an equi-join on the hash of both. Pairs that meet are verified by
Spark's banded edit distance, which stops beyond the threshold.

Texts are shuffled once, by row; every later step reads that shuffle again and joins small
tables of line numbers to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.llm.arrays import NULL_ID

PLACE = ("row", "no")


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and size of the i-th of ``parts`` even segments of a line."""
    base, longer = F.floor(length / parts), parts - length % parts
    start = i * base + F.greatest(F.lit(0), i - longer)
    return start.cast("int"), (base + F.when(longer <= i, 1).otherwise(0)).cast("int")


def _key(i: int, length: Column, piece: Column) -> Column:
    return F.xxhash64(F.lit(i), length.cast("int"), piece)


def offered_keys(line: Column, length: Column, edits: int) -> Column:
    keys = []
    for i in range(edits + 1):
        start, size = segment(length, i, edits + 1)
        keys.append(_key(i, length, F.substr(line, start + 1, size)))
    return F.array(*keys)


def probed_keys(line: Column, length: Column, edits: int) -> Column:
    """Keys under which other lines may have offered a segment that stands in this one.

    Segment i can only have moved as far as edits before it and after it allow. Keys that
    the line offers itself are left out.
    """
    keys = []
    for shorter in range(edits + 1):
        other = length - shorter
        for i in range(edits + 1):
            start, size = segment(other, i, edits + 1)
            low = max(-i, shorter - (edits - i))
            for shift in range(low, min(i, shorter + edits - i) + 1):
                if shorter or shift:
                    at = start + shift
                    fits = (at >= 0) & (at + size <= length)
                    keys.append(F.when(fits, _key(i, other, F.substr(line, at + 1, size))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _lines() -> Column:
    return F.split(_text(), "\n", -1)


def _base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row`` names id and text together; rows that are equal in both are one.

    ``body`` holds the id, as text that sorts like it, and the text: one column, so that all
    uses ask for the same columns and share one shuffle.
    """
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NULL_ID)))
    order = F.lpad(F.hex(doc.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    mark = F.when(F.col(text).isNull(), "N").otherwise("T")
    return docs.select(
        F.xxhash64(doc_id, text).alias("row"),
        F.concat(order, mark, F.coalesce(text, F.lit(""))).alias("body"),
    )


def _doc() -> Column:
    return F.substr("body", F.lit(1), F.lit(16))


def _text() -> Column:
    return F.substr("body", F.lit(18))


def first_lines(base: DataFrame) -> DataFrame:
    """Places (doc, row, no) of the first of all equal lines that are not blank."""
    lines = base.select(
        _doc().alias("doc"), "row", F.posexplode(_lines()).alias("no", "line")
    )
    content = (F.xxhash64("line").alias("h"), F.hash("line").alias("g"))
    return (
        lines.where(F.length(F.trim("line")) > 0)
        .select("doc", "row", "no", *content)
        .groupBy("h", "g")
        .agg(F.min(F.struct("doc", "row", "no")).alias("place"))
        .select("place.*")
    )


def _numbers(places: DataFrame, name: str) -> DataFrame:
    """Line numbers per row: as many as the row has lines."""
    return places.groupBy("row").agg(F.collect_set("no").alias(name))


def _text_of(base: DataFrame, places: DataFrame) -> DataFrame:
    """doc, row, no and line of ``places``. A text is split once, whatever is asked of it."""
    some = base.join(_numbers(places, "nos").hint("shuffle_hash"), "row")
    asked = F.get(
        F.transform(
            F.array(_lines()),
            lambda lines: F.transform(
                "nos", lambda i: F.struct(i.alias("no"), F.get(lines, i).alias("line"))
            ),
        ),
        0,
    )
    asked = some.select(_doc().alias("doc"), "row", F.explode(asked).alias("at"))
    return asked.select("doc", "row", "at.*")


def _second(places: DataFrame) -> DataFrame:
    return places.select(*[F.col(c).alias(f"{c}2" if c != "key" else c) for c in places.columns])


def _place(mark: str = "") -> Column:
    return F.struct(*[F.col(c + mark) for c in ("doc", "row", "no")])


def _neighbours(lines: DataFrame) -> DataFrame:
    """Places of lines within one edit of an earlier one, without pairs of a common group.

    Lines equal but for the character at one index differ by a substitution, and all but the
    first of such a group go. A line that is another without one character meets it by hash.
    """
    length = F.length("line")
    without = lines.select(
        "doc",
        "row",
        "no",
        length.alias("length"),
        F.explode(
            F.transform(
                F.sequence(F.lit(0), length - 1),
                lambda i: F.struct(
                    i.alias("i"),
                    F.xxhash64(F.substr("line", F.lit(1), i), F.substr("line", i + 2)).alias("h"),
                    F.xxhash64(
                        F.concat(F.substr("line", F.lit(1), i), F.substr("line", i + 2))
                    ).alias("whole"),
                ),
            )
        ).alias("cut"),
    ).select("doc", "row", "no", "length", "cut.*")
    same = without.groupBy("h", "i", "length").agg(
        F.min(_place()).alias("first"), F.count("*").alias("n")
    )
    replaced = (
        without.join(same.where("n > 1"), ["h", "i", "length"])
        .where(_place() > F.col("first"))
        .select(*PLACE)
    )
    whole = lines.select(
        F.col("doc").alias("doc2"),
        F.col("row").alias("row2"),
        F.col("no").alias("no2"),
        F.xxhash64("line").alias("whole"),
        (length + 1).alias("length"),
    )
    inserted = without.join(whole, ["whole", "length"]).select(
        F.when(_place() > _place("2"), F.col("row")).otherwise(F.col("row2")).alias("row"),
        F.when(_place() > _place("2"), F.col("no")).otherwise(F.col("no2")).alias("no"),
    )
    return replaced.unionByName(inserted)


def near_lines(
    base: DataFrame, firsts: DataFrame, edits: int, least_chars: int, crowd: int
) -> DataFrame:
    """Places (row, no) of first lines that are within ``edits`` edits of an earlier one."""
    length = F.length("line")
    lines = _text_of(base, firsts.select(*PLACE)).where(length >= least_chars)
    line = F.col("line")
    offered = lines.select(F.explode(offered_keys(line, length, edits)).alias("key"), *PLACE)
    probed = lines.select(F.explode(probed_keys(line, length, edits)).alias("key"), *PLACE)
    # Both columns are named, so that counting reads the same shuffle as the joins below.
    offered, probed = offered.repartition("key"), probed.repartition("key")
    counts = offered.groupBy("key").agg(
        F.count_if((F.col("no") >= 0) | (F.col("row") == 0)).alias("n")
    )
    few = offered.join(counts.where(F.col("n") <= crowd), "key") if edits == 1 else offered
    few = few.select("key", *PLACE)
    pairs = (
        few.join(_second(offered), "key")
        .unionByName(few.join(_second(probed), "key"))
        .where("row <> row2 OR no <> no2")
        .select(*PLACE, "row2", "no2")
        .distinct()
    )
    met = pairs.select(*PLACE).unionByName(
        pairs.select(F.col("row2").alias("row"), F.col("no2").alias("no"))
    )
    texts = _text_of(base, met.distinct())
    close = F.levenshtein(F.col("line"), F.col("line2"), edits)
    later = _place() > _place("2")
    near = (
        pairs.join(texts, list(PLACE))
        .join(_second(texts), ["row2", "no2"])
        .where(close.between(0, edits))
        .select(
            F.when(later, F.col("row")).otherwise(F.col("row2")).alias("row"),
            F.when(later, F.col("no")).otherwise(F.col("no2")).alias("no"),
        )
    )
    if edits == 1:
        crowded = counts.where(F.col("n") > crowd).select("key")
        there = offered.join(crowded, "key").unionByName(probed.join(crowded, "key"))
        near = near.unionByName(_neighbours(_text_of(base, there.select(*PLACE).distinct())))
    return near.distinct()


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    edits: int = 1,
    least_chars: int = 40,
    crowd: int = 32,
) -> DataFrame:
    """``docs`` with the kept lines as text, and n_lines and n_removed.

    A line that is not blank goes when an equal one stands earlier: in a document with a
    smaller id, or earlier in the same document. Lines of ``least_chars`` characters or more
    also go when an earlier such line is within ``edits`` edits (insertions, deletions,
    substitutions of characters). Lines are judged on the input. Blank lines stay. Lines end
    at U+000A. A null text stays null with no lines; a null id sorts last; rows with equal
    ids are told apart by their texts, in a fixed order, and rows equal in both keep the same
    lines. Other columns stay as they are; ones named n_lines or n_removed are replaced.

    With one edit, a segment that more than ``crowd`` different lines offer makes no pairs:
    its lines meet by what is left of them without one character, which finds the same lines
    in proportion to their number and length.
    """
    base = _base(docs, doc_id, text)
    firsts = first_lines(base)
    first = _numbers(firsts.select(*PLACE), "firsts")
    near = _numbers(near_lines(base, firsts, edits, least_chars, crowd), "nears")
    judged = (
        base.join(first.hint("shuffle_hash"), "row", "left")
        .join(near.hint("shuffle_hash"), "row", "left")
    )
    none = F.array().cast("array<int>")
    stays = F.array_except(F.coalesce("firsts", none), F.coalesce("nears", none))
    known = F.substr("body", F.lit(17), F.lit(1)) == "T"
    count = F.when(known, F.size("lines")).otherwise(0)
    judged = judged.select(
        "row", known.alias("known"), "body", _lines().alias("lines"), stays.alias("stays")
    )
    blank = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: F.length(F.trim(F.get("lines", i))) == 0,
    )
    judged = judged.withColumns(
        {"n": count, "kept": F.array_sort(F.array_union("stays", blank))}
    )
    judged = judged.select(
        "row",
        F.when(
            F.col("known"),
            F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n"),
        ).alias("_text"),
        F.col("n").cast("long").alias("n_lines"),
        F.when(F.col("n") == 0, 0).otherwise(F.col("n") - F.size("kept")).cast("long")
        .alias("n_removed"),
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed") or c == text]
    rest = docs.select(
        F.xxhash64(doc_id, text).alias("row"), F.struct(*[c for c in names if c != text]).alias("rest")
    )
    out = judged.dropDuplicates(["row"]).join(rest, "row")
    return out.select(
        *[F.col("_text" if c == text else f"rest.`{c}`").alias(c) for c in names],
        "n_lines",
        "n_removed",
    )
