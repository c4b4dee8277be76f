"""How filters of a corpus overlap, for every order in which they may be applied.

A document fails some of the filters: a row of a mask matrix with 0 where it fails and
infinity elsewhere. An order is a permutation; its inverse tells the step of each filter. The
min-plus product of the mask matrix and the matrix of these steps is the step that removes
the document, and what a step removes, keeps or finds removed already are weighted scatter
counts over that product.

The product needs no document twice: equal mask rows give equal results, so documents are
counted per part and mask first, and 2**n masks meet the n! orders. That table does not
grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Filters beyond this number would need more orders than a literal can hold.
MOST_FILTERS = 6
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: short, repetitive, shouting, with markup."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        "C": 100 * upper.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(failures: Sequence[Column]) -> Column:
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def masks(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column],
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and set of failed filters.

    Bit i of the mask is the i-th of ``failures``; one more bit is set where the text equals
    that of a smaller id. Columns of ``docs`` are read by the names given, and others do not
    matter. A null text is an empty one, a null part the empty string. Rows of equal id and
    text are as many documents; a null id is neither labelled nor smaller or greater than
    others. Of several labels of one id any 1 counts.

    A text that a third of all rows holds is one row per part and label before it is
    shuffled, and rows without an id are spread before they meet the labels.
    """
    whole = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias(text),
    )
    judged = whole.select(
        "id",
        F.when(F.col("id").isNull(), 1 + F.pmod(F.monotonically_increasing_id(), F.lit(997)))
        .otherwise(0)
        .alias("salt"),
        "part",
        F.unhex(F.sha2(F.col(text), 256)).alias("same"),
        _mask(list(failures.values())).alias("mask"),
    )
    marked = labels.groupBy(F.col(doc_id).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = marked.withColumn("salt", F.lit(0).cast("long"))
    key = ["same", "part", "mask", "good", "toxic"]
    rows = (
        judged.join(marked, ["id", "salt"], "left")
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
        .groupBy("id", "salt", *key)
        .agg(F.count("*").alias("n"))
    )
    numbered = F.col("id").isNotNull()
    texts = rows.groupBy(*key).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(numbered, F.col("n")).otherwise(0)).alias("n_numbered"),
        F.min(F.when(numbered, F.struct("id", "n"))).alias("least"),
    )
    first = F.min("least.id").over(Window.partitionBy("same"))
    own = F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    copies = texts.withColumn("copies", F.col("n_numbered") - own)
    bit = 1 << len(failures)
    halves = F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + bit).alias("mask"), F.col("copies").alias("n")),
    )
    cells = copies.select("part", "good", "toxic", F.inline(halves)).where("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _orders(letters: str) -> Column:
    """All orders of ``letters`` with the inverse permutation: the step of each filter."""
    rows = (
        f"struct('{''.join(order)}' AS filter_order, "
        f"array({', '.join(str(order.index(f) + 1) for f in letters)}) AS steps)"
        for order in permutations(letters)
    )
    return F.expr(f"array({', '.join(rows)})")


def removal_ranks(cells: DataFrame, letters: str) -> DataFrame:
    """``cells`` times all orders, with ``removed_at``: the min-plus product, or one more
    than the number of filters for what no filter removes."""
    fails = [F.col("mask").bitwiseAND(1 << i) != 0 for i in range(len(letters))]
    product = F.least(
        F.lit(len(letters) + 1),
        *(F.when(f, F.get("steps", i)) for i, f in enumerate(fails)),
    )
    orders = cells.select("*", F.explode(_orders(letters)).alias("o")).select(
        *cells.columns, "o.filter_order", "o.steps"
    )
    return orders.withColumn("removed_at", product)


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step and the counts of ``MEASURES``; ``cells`` as from ``masks``.

    Every part of ``cells`` has a row for each order and step, zeros included; without
    cells there are none.
    """
    if not 1 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"two to {MOST_FILTERS} different letters, not {letters!r}")
    last = len(letters)
    ranks = removal_ranks(cells, letters)
    step = F.explode(F.sequence(F.lit(1), F.lit(last))).alias("step")
    bits = F.array(*(F.lit(1 << i) for i in range(last)))
    ranks = ranks.select("*", step).withColumn(
        "own", F.element_at(bits, F.array_position("steps", F.col("step")).cast("int"))
    )
    at, own = F.col("removed_at"), F.col("own")
    here, failing = at == F.col("step"), F.col("mask").bitwiseAND(own) != 0

    def total(weight: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(weight)).otherwise(0))

    counted = ranks.groupBy("part", "filter_order", "step", "own").agg(
        total("n", at > F.col("step")).alias("kept"),
        total("n", here).alias("removed"),
        total("n", failing & (at < F.col("step"))).alias("redundant"),
        total("n", F.col("mask") == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    credit = F.sum("removed").over(Window.partitionBy("part", "own"))
    return counted.withColumn("shapley", credit).select("part", "filter_order", "step", *MEASURES)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E; E is a text that a smaller id has too."""
    failures = text_failures(F.col("text"))
    return audit(masks(docs, labels, failures), "".join(failures) + "E")
