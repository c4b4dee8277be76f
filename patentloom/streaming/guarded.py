"""The live feed read once: mergeable reports, and a quarantine for what they leave out.

Each micro-batch is cut three ways by one pass: rows that do not parse or lack a value, rows
whose bucket had closed before the batch began, and the others. The first two go to the
quarantine with the reason; the others become partial counts, a few rows per bucket and
branch. Both are stored under the number of the batch, and a report adds the partial counts up.
Distinct inventors are kept as sketches, which unite without loss: a month that history and
stream both fill is estimated like one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom.functions.dates import bucket_start, parsed_date
from patentloom.sinks.ledger import Ledger
from patentloom.sources.streams import CORRUPT

REJECTED = f"reason string, patent_id string, patent_date string, branch string, {CORRUPT} string"
PARTIAL = (
    "timestamp timestamp, branch string, grant_count long, claims long, claimed long, "
    "male_count long, female_count long, inventors binary"
)
NEEDED = ["patent_id", "branch", "num_claims", "inventors", "applicants"]
#: The batch number of what a batch job has counted.
HISTORY = -1
#: Days that a bucket stays open behind the newest one.
OPEN_DAYS = 62
#: 2 ** 12 registers: a relative error of about 1.04 / 64.
SKETCH = 12


@dataclass(frozen=True)
class GuardedFeed:
    """Ledgers of a feed: ``partial`` counts, the newest bucket per batch, the ``rejected``."""

    partial: Ledger
    marks: Ledger
    rejected: Ledger
    grain: str = "month"
    open_days: int = OPEN_DAYS

    @classmethod
    def at(cls, spark: SparkSession, root: str, **options) -> GuardedFeed:
        return cls(
            Ledger(spark, f"{root}/partial", PARTIAL),
            Ledger(spark, f"{root}/marks", "newest timestamp"),
            Ledger(spark, f"{root}/rejected", REJECTED),
            **options,
        )

    def judged(self, records: DataFrame, batch_id: int) -> DataFrame:
        """``records`` with their bucket and a reason, null for those that count.

        The mark is that of the batches before, so a batch is judged as one, whatever the
        order of its rows, and judged alike when it is replayed.
        """
        date = parsed_date(F.col("patent_date"))
        newest = self.marks.read(before=batch_id).agg(F.max("newest")).scalar()
        bucket = bucket_start(date, self.grain).cast("timestamp")
        late = bucket < newest - F.make_interval(days=F.lit(self.open_days))
        missing = F.lit(False)
        for column in NEEDED:
            missing = missing | F.col(column).isNull()
        return records.withColumn("timestamp", bucket).withColumn(
            "reason",
            F.when(F.col(CORRUPT).isNotNull(), "malformed")
            .when(missing, "incomplete")
            .when(date.isNull(), "undated")
            .when(late, "late"),
        )

    def take(self, records: DataFrame, batch_id: int) -> None:
        """One micro-batch: the ``foreachBatch`` function of the feed."""
        judged = self.judged(records, batch_id).persist()
        try:
            rejected = judged.where(F.col("reason").isNotNull())
            self.rejected.write(
                batch_id, rejected.select(*(f.split()[0] for f in REJECTED.split(", ")))
            )
            accepted = judged.where(F.col("reason").isNull())
            self.partial.write(batch_id, partial_counts(accepted))
            # Last: a batch that fails before is judged by the same mark again.
            self.marks.write(batch_id, accepted.agg(F.max("timestamp").alias("newest")))
        finally:
            judged.unpersist()

    def start_from(self, history: DataFrame) -> None:
        """Count complete, dated ``history`` as what came before the first batch."""
        dated = self.judged(history.withColumn(CORRUPT, F.lit(None).cast("string")), HISTORY)
        accepted = dated.where(F.col("reason").isNull())
        self.partial.write(HISTORY, partial_counts(accepted))
        self.marks.write(HISTORY, accepted.agg(F.max("timestamp").alias("newest")))

    def trends(self) -> DataFrame:
        return merged(self.partial.read())

    def rejections(self) -> DataFrame:
        """Rows per reason and batch."""
        return self.rejected.read().groupBy("batch_id", "reason").agg(F.count("*").alias("rows"))


def partial_counts(records: DataFrame) -> DataFrame:
    """What can be added up: counts and sums per bucket and branch, and a sketch of inventors."""

    def of_gender(code: str) -> Column:
        return F.size(F.filter("inventors", lambda i: i["gender"] == code)).cast("long")

    counted = records.select(
        "timestamp",
        "branch",
        F.col("num_claims").try_cast("int").cast("long").alias("c"),
        of_gender("M").alias("m"),
        of_gender("F").alias("f"),
        F.posexplode_outer(F.transform("inventors", lambda i: i["inventor_name"])).alias("at", "name"),
    )
    # A record has a row per inventor here; its own counts go with the first.
    first = F.coalesce(F.col("at"), F.lit(0)) == 0

    def once(value: str) -> Column:
        return F.coalesce(F.sum(F.when(first, F.col(value))), F.lit(0))

    return counted.groupBy("timestamp", "branch").agg(
        F.count_if(first).alias("grant_count"),
        once("c").alias("claims"),
        F.count_if(first & F.col("c").isNotNull()).alias("claimed"),
        once("m").alias("male_count"),
        once("f").alias("female_count"),
        F.hll_sketch_agg("name", SKETCH).alias("inventors"),
    )


def merged(partial: DataFrame) -> DataFrame:
    """The report over partial counts, of whatever batches they are."""
    sums = ("grant_count", "claims", "claimed", "male_count", "female_count")
    added = partial.groupBy("timestamp", "branch").agg(
        *(F.sum(c).alias(c) for c in sums),
        F.hll_sketch_estimate(F.hll_union_agg("inventors")).alias("inventor_estimate"),
    )
    return added.select(
        "timestamp",
        F.to_date("timestamp").alias("year"),
        "branch",
        "grant_count",
        (F.col("claims") / F.nullif("claimed", F.lit(0))).alias("avg_claims"),
        "male_count",
        "female_count",
        "inventor_estimate",
    )
