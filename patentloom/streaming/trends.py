"""Trends over the live patent feed, upserted into keyed tables.

The default is ``update`` output: every micro-batch sends the buckets it changed and
the upsert replaces them, so a dashboard is current after each batch. In ``append``
output a bucket is sent once, after the watermark has passed it; rows arriving later
than ``delay`` behind the newest are then dropped and counted in the query progress.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patentloom.functions.dates import bucket_start, parsed_date
from patentloom.functions.names import prefixed
from patentloom.operators.quality import drop_any_null
from patentloom.sinks.keyed import KeyedTable
from patentloom.sinks.scoped import ScopedTable
from patentloom.sources.streams import parsed_only

# Event time is the first day of a month. Two whole months let a month's files come
# in any order; one month would already lose rows delivered after the turn.
DEFAULT_DELAY = "62 days"

TREND_KEYS = ["year", "branch"]
GEO_KEYS = ["timestamp", "branch", "state"]


def prepared(
    records: DataFrame,
    grain: str = "month",
    delay: str = DEFAULT_DELAY,
    from_date: str | None = None,
) -> DataFrame:
    """Complete records with their bucket as watermarked event time.

    Where a batch has filled the report tables up to a date, ``from_date`` is that date, the
    start of a bucket: the stream knows its own records only, and an older one among them
    would replace a closed bucket. Such records are set aside and counted in the query
    progress (observed metric ``set_aside``).
    """
    date = parsed_date(F.col("patent_date"))
    dated = drop_any_null(parsed_only(records)).where(date.isNotNull())
    if from_date is not None:
        old = date < F.lit(from_date).cast("date")
        dated = dated.observe("set_aside", F.count_if(old).alias("records")).where(~old)
    return (
        dated
        .withColumn("timestamp", bucket_start(date, grain).cast("timestamp"))
        .withColumn("num_claims", F.col("num_claims").try_cast("int"))
        .withWatermark("timestamp", delay)
    )


def _with_year(counts: DataFrame, *columns: str) -> DataFrame:
    return counts.select("timestamp", F.to_date("timestamp").alias("year"), "branch", *columns)


def patent_trends(records: DataFrame) -> DataFrame:
    """Patents and mean claims per bucket and branch, before inventors are exploded."""
    counts = records.groupBy("timestamp", "branch").agg(
        F.count("patent_id").cast("int").alias("grant_count"),
        F.avg("num_claims").cast("float").alias("avg_claims"),
    )
    return _with_year(counts, "grant_count", "avg_claims")


def _inventors(records: DataFrame) -> DataFrame:
    return records.select(
        "timestamp", "branch", "patent_id", F.explode("inventors").alias("inventor")
    )


def gender_trends(records: DataFrame) -> DataFrame:
    counts = _inventors(records).groupBy("timestamp", "branch").agg(
        F.count_if(F.col("inventor.gender") == "M").cast("int").alias("male_count"),
        F.count_if(F.col("inventor.gender") == "F").cast("int").alias("female_count"),
    )
    return _with_year(counts, "male_count", "female_count")


def geo_distribution(
    records: DataFrame, prefix: str = "US-", counting: str = "rows"
) -> DataFrame:
    """Inventors and patents per bucket, branch and state.

    ``counting="rows"`` counts inventor rows. ``"approx_distinct"`` counts distinct
    values with a sketch. Both keep a few bytes of state per report row however many
    inventors a state has. ``"distinct"`` is exact, as the batch report is: see
    ``distinct_geo``.
    """
    if counting == "distinct":
        return distinct_geo(records, prefix)
    count = {"rows": F.count, "approx_distinct": F.approx_count_distinct}[counting]
    counts = _inventors(records).groupBy(
        "timestamp", "branch", F.col("inventor.state").alias("state")
    ).agg(
        count("inventor.inventor_name").cast("int").alias("inventor_count"),
        count("patent_id").cast("int").alias("patent_count"),
    )
    return _with_year(
        counts, prefixed(F.col("state"), prefix).alias("state"), "inventor_count", "patent_count"
    )


def distinct_geo(records: DataFrame, prefix: str = "US-") -> DataFrame:
    """Distinct inventors and patents per bucket, branch and state, by two stateful operators.

    The first lets each (bucket, branch, state, inventor or patent) through once, the second
    counts what comes. Both forget a bucket when the watermark has passed it, so the state is
    that of the open buckets: one small row per distinct value.
    """
    values = F.array(
        F.struct(F.lit(True).alias("person"), F.col("inventor.inventor_name").alias("value")),
        F.struct(F.lit(False).alias("person"), F.col("patent_id").alias("value")),
    )
    seen = _inventors(records).select(
        "timestamp", "branch", F.col("inventor.state").alias("state"), F.inline(values)
    )
    once = seen.where(F.col("value").isNotNull()).dropDuplicates(
        ["timestamp", "branch", "state", "person", "value"]
    )
    counts = once.groupBy("timestamp", "branch", "state").agg(
        F.count_if("person").cast("int").alias("inventor_count"),
        F.count_if(~F.col("person")).cast("int").alias("patent_count"),
    )
    return _with_year(
        counts, prefixed(F.col("state"), prefix).alias("state"), "inventor_count", "patent_count"
    )


#: Columns of the three report tables among those of ``all_trends``.
REPORTS = {
    "patent_trends": ["timestamp", "year", "branch", "grant_count", "avg_claims"],
    "gender_trends": ["timestamp", "year", "branch", "male_count", "female_count"],
    "geo_distribution": ["timestamp", "year", "branch", "state", "inventor_count", "patent_count"],
}


def all_trends(records: DataFrame, prefix: str = "US-") -> DataFrame:
    """The three reports as one stream with one stateful aggregation.

    A record becomes one row for the patents, and two per inventor; the key says which
    report a row is for. ``report`` tells the rows of the result apart.
    """

    def row(report: str, **values: Column) -> Column:
        kinds = {"state": "string", "claims": "int", "gender": "string", "name": "string"}
        cells = [values.get(k, F.lit(None)).cast(v).alias(k) for k, v in kinds.items()]
        return F.struct(F.lit(report).alias("report"), *cells)

    tagged = F.concat(
        F.array(row("patent_trends", claims=F.col("num_claims"))),
        F.transform("inventors", lambda i: row("gender_trends", gender=i["gender"])),
        F.transform(
            "inventors",
            lambda i: row("geo_distribution", state=i["state"], name=i["inventor_name"]),
        ),
    )
    rows = records.select("timestamp", "branch", "patent_id", F.inline(tagged))
    counts = rows.groupBy("timestamp", "branch", "report", "state").agg(
        F.count("patent_id").cast("int").alias("patents"),
        F.avg("claims").cast("float").alias("avg_claims"),
        F.count_if(F.col("gender") == "M").cast("int").alias("male_count"),
        F.count_if(F.col("gender") == "F").cast("int").alias("female_count"),
        F.count("name").cast("int").alias("inventor_count"),
    )
    return counts.select(
        "report",
        "timestamp",
        F.to_date("timestamp").alias("year"),
        "branch",
        prefixed(F.col("state"), prefix).alias("state"),
        F.col("patents").alias("grant_count"),
        "avg_claims",
        "male_count",
        "female_count",
        "inventor_count",
        F.col("patents").alias("patent_count"),
    )


def fan_out(tables: dict[str, KeyedTable]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts the rows of ``all_trends`` into their tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, table in tables.items():
                rows = batch.where(F.col("report") == name).select(*REPORTS[name])
                if not rows.isEmpty():
                    table.upsert(rows)
        finally:
            batch.unpersist()

    return write


def upsert_into(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. A batch replayed after a failure upserts the same
    rows again, which leaves the table as it was."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # One evaluation of the stateful batch for the test and the write.
        batch.persist()
        try:
            if not batch.isEmpty():
                table.upsert(batch)
        finally:
            batch.unpersist()

    return write


def start_batches(
    report: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``report`` into a ``foreachBatch`` function; each query needs its own checkpoint.

    The number of state partitions is fixed by the first run of a checkpoint; reports
    of a few thousand rows want far fewer than a batch shuffle does.
    """
    writer = (
        report.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    conf, key = report.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    try:
        if state_partitions:
            conf.set(key, str(state_partitions))
        return writer.start()
    finally:
        conf.set(key, before)


def start_upsert(
    report: DataFrame, table: KeyedTable, checkpoint: str, **options
) -> StreamingQuery:
    """Run ``report`` into ``table``; options are those of ``start_batches``."""
    return start_batches(report, upsert_into(table), checkpoint, **options)


def trend_tables(spark, root: str) -> dict[str, KeyedTable]:
    """The three report tables below ``root`` with their keys, in one part per bucket: a
    micro-batch reads and writes the buckets it has rows of."""
    keys = {
        "patent_trends": (TREND_KEYS, "grant_count"),
        "gender_trends": (TREND_KEYS, "male_count"),
        "geo_distribution": (GEO_KEYS, "inventor_count"),
    }
    part = F.col("year").cast("string")
    return {
        name: ScopedTable(spark, f"{root}/{name}", own, first, part=part)
        for name, (own, first) in keys.items()
    }


def start_all(
    records: DataFrame,
    root: str,
    checkpoints: str,
    grain: str = "month",
    from_date: str | None = None,
    **options,
) -> list[StreamingQuery]:
    """Start the query that fills the three trend tables, from the cutoff of the batch tables
    where there are any (``from_date``): one read of the feed, one checkpoint."""
    tables = trend_tables(records.sparkSession, root)
    report = all_trends(prepared(records, grain, from_date=from_date))
    return [start_batches(report, fan_out(tables), f"{checkpoints}/trends", **options)]
