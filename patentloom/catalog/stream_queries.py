"""Registered streaming queries: files in, keyed tables out, read after the last batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import rounded, zoneless
from patentloom.catalog.tables import Tables
from patentloom.plans import branches
from patentloom.session import scratch_path
from patentloom.sinks.keyed import KeyedTable
from patentloom.sources import streams
from patentloom.streaming import guarded, simple, trends

# Many files in two micro-batches, so that every bucket is updated again and, whatever the
# order of the records, none is behind the watermark.
RECORDS_PER_FILE = 500


def delivered(df: DataFrame) -> str:
    """``df`` as JSON files of a stream input folder."""
    path = scratch_path(df.sparkSession, "stream")
    df.write.option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)
    return path


def half(t: Tables, path: str) -> int:
    """Files per micro-batch for two batches."""
    return max(1, -(-len(t.spark.read.text(path).inputFiles()) // 2))


def patent_stream(
    t: Tables, patents: DataFrame | None = None, from_date: str | None = None
) -> DataFrame:
    path = delivered(t.live_patents if patents is None else patents)
    return trends.prepared(
        streams.json_stream(t.spark, path, files_per_trigger=half(t, path)),
        from_date=from_date,
    )


def run(report: DataFrame, table: KeyedTable, output_mode: str = "update") -> DataFrame:
    """The table after the stream has used up its input."""
    spark = table.spark
    query = trends.start_upsert(
        report,
        table,
        scratch_path(spark, "checkpoint"),
        output_mode=output_mode,
        available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    query.awaitTermination()
    return table.read()


def trend(name: str, build: Callable[[DataFrame], DataFrame], output_mode: str = "update"):
    def query(t: Tables) -> DataFrame:
        table = trends.trend_tables(t.spark, scratch_path(t.spark, "tables"))[name]
        return zoneless(run(build(patent_stream(t)), table, output_mode), "timestamp")

    return query


def history_plus_stream(t: Tables, overlap: bool = False) -> DataFrame:
    """Months before August from a batch, the others from the stream, in one table.

    With ``overlap`` the stream delivers all records again, those of closed months too.
    """
    patents = t.live_patents.where(F.col("branch").isNotNull())
    table = trends.trend_tables(t.spark, scratch_path(t.spark, "tables"))["patent_trends"]
    past = F.col("patent_date") < "2024-08-01"
    table.insert(
        branches.patent_trends(
            patents.where(past).withColumns(
                {
                    "patent_date": F.col("patent_date").cast("date"),
                    "num_claims": F.col("num_claims").cast("int"),
                }
            )
        )
    )
    live = patents if overlap else patents.where(~past)
    cutoff = "2024-08-01" if overlap else None
    merged = run(trends.patent_trends(patent_stream(t, live, cutoff)), table)
    return rounded(zoneless(merged, "timestamp"), "avg_claims")


MONTH = "CAST(date_trunc('month', patent_date) AS DATE)"
STAMP = f"CAST({MONTH} AS TIMESTAMP) AS timestamp, {MONTH} AS year, branch"
PATENT_TRENDS = f"""
    SELECT {STAMP}, CAST(count(*) AS INTEGER) AS grant_count,
           round(CAST(CAST(avg(num_claims) AS FLOAT) AS DOUBLE), 6) AS avg_claims
    FROM live_patents WHERE branch IS NOT NULL GROUP BY 1, 2, 3"""
register(
    "stream_patent_trends",
    lambda t: rounded(trend("patent_trends", trends.patent_trends)(t), "avg_claims"),
    PATENT_TRENDS,
)
register(
    "stream_patent_trends_complete",
    lambda t: rounded(
        trend("patent_trends", trends.patent_trends, "complete")(t), "avg_claims"
    ),
    PATENT_TRENDS,
)
register("history_plus_stream", history_plus_stream, PATENT_TRENDS)
register(
    "history_plus_stream_overlap", lambda t: history_plus_stream(t, True), PATENT_TRENDS
)
register(
    "stream_gender_trends",
    trend("gender_trends", trends.gender_trends),
    f"""SELECT {STAMP},
               CAST(count(*) FILTER (WHERE gender = 'M') AS INTEGER) AS male_count,
               CAST(count(*) FILTER (WHERE gender = 'F') AS INTEGER) AS female_count
        FROM live_inventors GROUP BY 1, 2, 3""",
)
register(
    "stream_geo_distribution",
    trend("geo_distribution", trends.geo_distribution),
    f"""SELECT {STAMP}, 'US-' || state AS state,
               CAST(count(inventor_name) AS INTEGER) AS inventor_count,
               CAST(count(patent_id) AS INTEGER) AS patent_count
        FROM live_inventors GROUP BY 1, 2, 3, 4""",
)


register(
    "stream_geo_distinct",
    trend("geo_distribution", lambda ready: trends.geo_distribution(ready, counting="distinct")),
    f"""SELECT {STAMP}, 'US-' || state AS state,
               CAST(count(DISTINCT inventor_name) AS INTEGER) AS inventor_count,
               CAST(count(DISTINCT patent_id) AS INTEGER) AS patent_count
        FROM live_inventors GROUP BY 1, 2, 3, 4""",
)


def stream_all_trends(t: Tables) -> DataFrame:
    """All three tables of one query, below each other."""
    root = scratch_path(t.spark, "tables")
    tables = trends.trend_tables(t.spark, root)
    query = trends.start_batches(
        trends.all_trends(patent_stream(t)),
        trends.fan_out(tables),
        scratch_path(t.spark, "checkpoint"),
        available_now=True,
        state_partitions=t.spark.sparkContext.defaultParallelism,
    )
    query.awaitTermination()
    shape = {"state": "string", "grant_count": "int", "avg_claims": "double", "male_count": "int",
             "female_count": "int", "inventor_count": "int", "patent_count": "int"}
    parts = [
        rounded(table.read(), *({"avg_claims"} & set(trends.REPORTS[name]))).select(
            F.lit(name).alias("report"),
            F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
            "branch",
            *(
                (F.col(c) if c in trends.REPORTS[name] else F.lit(None)).cast(kind).alias(c)
                for c, kind in shape.items()
            ),
        )
        for name, table in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register(
    "stream_all_trends",
    stream_all_trends,
    f"""
    SELECT 'patent_trends' AS report, CAST({MONTH} AS TIMESTAMP) AS timestamp, branch,
           CAST(NULL AS VARCHAR) AS state, CAST(count(*) AS INTEGER) AS grant_count,
           round(CAST(CAST(avg(num_claims) AS FLOAT) AS DOUBLE), 6) AS avg_claims,
           CAST(NULL AS INTEGER) AS male_count, CAST(NULL AS INTEGER) AS female_count,
           CAST(NULL AS INTEGER) AS inventor_count, CAST(NULL AS INTEGER) AS patent_count
    FROM live_patents WHERE branch IS NOT NULL GROUP BY 1, 2, 3
    UNION ALL
    SELECT 'gender_trends', CAST({MONTH} AS TIMESTAMP), branch, NULL, NULL, NULL,
           CAST(count(*) FILTER (WHERE gender = 'M') AS INTEGER),
           CAST(count(*) FILTER (WHERE gender = 'F') AS INTEGER), NULL, NULL
    FROM live_inventors GROUP BY 1, 2, 3
    UNION ALL
    SELECT 'geo_distribution', CAST({MONTH} AS TIMESTAMP), branch, 'US-' || state, NULL, NULL,
           NULL, NULL, CAST(count(inventor_name) AS INTEGER), CAST(count(patent_id) AS INTEGER)
    FROM live_inventors GROUP BY 1, 2, 3, 4""",
)

# A feed in five deliveries: records come with their quarter, one in ten a delivery later, and
# one in 37 two later. Some lines are cut off, some dates are none.
FILES_PER_DELIVERY = 2
DELIVERIES = 5


def guarded_feed(t: Tables) -> guarded.GuardedFeed:
    """The feed after all deliveries, each a micro-batch of its own."""
    number, date = F.col("patent_id").cast("long"), F.col("patent_date").cast("date")
    late = F.when(number % 10 == 0, 1).otherwise(0) + F.when(number % 37 == 0, 2).otherwise(0)
    delivery = F.least(F.quarter(date) + late, F.lit(DELIVERIES))
    dated = F.when(number % 47 == 0, "2024-02-31").otherwise(F.col("patent_date"))
    line = F.to_json(F.struct(*(c for c in t.live_patents.columns if c != "patent_date"), dated.alias("patent_date")))
    lines = t.live_patents.select(
        delivery.alias("delivery"), F.when(number % 53 == 0, F.substr(line, F.lit(1), F.lit(9))).otherwise(line).alias("value")
    )
    path = scratch_path(t.spark, "deliveries")
    for k in range(1, DELIVERIES + 1):  # one after another: the stream goes by the time of a file
        rows = lines.where(F.col("delivery") == k).select("value")
        rows.repartition(FILES_PER_DELIVERY).write.text(f"{path}/delivery-{k}")
    feed = guarded.GuardedFeed.at(t.spark, scratch_path(t.spark, "feed"))
    query = trends.start_batches(
        streams.json_stream(t.spark, f"{path}/*", files_per_trigger=FILES_PER_DELIVERY),
        feed.take,
        scratch_path(t.spark, "checkpoint"),
        output_mode="append",
        available_now=True,
    )
    query.awaitTermination()
    return feed


DELIVERED = f"""
    WITH delivered AS (
        SELECT *, CAST(patent_id AS BIGINT) AS number, CAST({MONTH} AS TIMESTAMP) AS timestamp,
               least(quarter(patent_date) + CASE WHEN CAST(patent_id AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END
                     + CASE WHEN CAST(patent_id AS BIGINT) % 37 = 0 THEN 2 ELSE 0 END, {DELIVERIES})
                   AS delivery
        FROM live_patents),
    first AS (
        SELECT *, CASE WHEN number % 53 = 0 THEN 'malformed' WHEN branch IS NULL THEN 'incomplete'
                       WHEN number % 47 = 0 THEN 'undated' END AS wrong
        FROM delivered),
    marks AS (
        SELECT d AS delivery, (SELECT max(timestamp) FROM first WHERE wrong IS NULL AND delivery < d)
                   AS newest
        FROM (SELECT unnest(range(1, {DELIVERIES} + 1)) AS d)),
    judged AS (
        SELECT f.*, coalesce(wrong, CASE WHEN timestamp < newest - INTERVAL 62 DAY THEN 'late' END)
                   AS reason
        FROM first f JOIN marks USING (delivery))"""


register(
    "stream_quarantine",
    lambda t: guarded_feed(t).rejected.read().select(
        "batch_id", "reason", F.when(F.col("reason") != "malformed", F.col("patent_id")).alias("patent_id")
    ),
    DELIVERED
    + """ SELECT delivery - 1 AS batch_id, reason,
                 CASE WHEN reason <> 'malformed' THEN patent_id END AS patent_id
          FROM judged WHERE reason IS NOT NULL""",
)
register(
    "stream_guarded_trends",
    lambda t: rounded(zoneless(guarded_feed(t).trends(), "timestamp"), "avg_claims"),
    DELIVERED
    + """, people AS (
        SELECT patent_id, branch, timestamp, 'person-' || ((user_id + i * 7) % 90) AS name,
               (user_id + i) % 3 AS gender
        FROM (SELECT *, unnest(range(0, user_id % 3 + 1)) AS i FROM judged WHERE reason IS NULL)),
    counted AS (
        SELECT timestamp, branch, count(*) FILTER (WHERE gender = 0) AS male_count,
               count(*) FILTER (WHERE gender = 1) AS female_count,
               count(DISTINCT name) AS inventor_estimate
        FROM people GROUP BY 1, 2)
    SELECT timestamp, CAST(timestamp AS DATE) AS year, branch, count(*) AS grant_count,
           round(avg(num_claims), 6) AS avg_claims, any_value(male_count) AS male_count,
           any_value(female_count) AS female_count, any_value(inventor_estimate) AS inventor_estimate
    FROM judged JOIN counted USING (timestamp, branch) WHERE reason IS NULL GROUP BY 1, 2, 3""",
)


def history_plus_stream_distinct(t: Tables) -> DataFrame:
    """Every month half from a batch and half from the stream: inventors of both count once."""
    even = F.col("patent_id").cast("long") % 2 == 0
    feed = guarded.GuardedFeed.at(t.spark, scratch_path(t.spark, "feed"), open_days=366)
    feed.start_from(t.live_patents.where(even))
    path = delivered(t.live_patents.where(~even))
    query = trends.start_batches(
        streams.json_stream(t.spark, path, files_per_trigger=half(t, path)),
        feed.take,
        scratch_path(t.spark, "checkpoint"),
        output_mode="append",
        available_now=True,
    )
    query.awaitTermination()
    return zoneless(feed.trends(), "timestamp").select(
        "timestamp", "branch", "grant_count", "inventor_estimate"
    )


register(
    "history_plus_stream_distinct",
    history_plus_stream_distinct,
    f"""SELECT CAST({MONTH} AS TIMESTAMP) AS timestamp, branch,
               count(DISTINCT patent_id) AS grant_count,
               count(DISTINCT inventor_name) AS inventor_estimate
        FROM live_inventors GROUP BY 1, 2""",
)


def stream_category_agg(t: Tables) -> DataFrame:
    path = delivered(t.category_prices)
    records = streams.json_stream(
        t.spark, path, "id int, category string, price double", files_per_trigger=half(t, path)
    )
    table = KeyedTable(t.spark, scratch_path(t.spark, "tables"), ["category"], "avg_price")
    return rounded(run(simple.category_prices(records), table), "avg_price")


register(
    "stream_category_agg",
    stream_category_agg,
    """SELECT event_type AS category, count(event_id) AS count,
              round(avg(value), 6) AS avg_price
       FROM events WHERE event_id % 59 <> 0 GROUP BY 1""",
)


def stream_word_count(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream")
    t.driver_table("conversations").select("text").write.option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)
    lines = streams.text_stream(t.spark, path, half(t, path))
    table = simple.word_table(t.spark, scratch_path(t.spark, "tables"))
    return run(simple.word_counts(lines), table)


register(
    "stream_word_count",
    stream_word_count,
    """SELECT word, count(*) AS count
       FROM (SELECT unnest(string_split(line, ' ')) AS word
             FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations))
       GROUP BY 1""",
)


def stream_parse_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream")
    t.facts.write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    out = scratch_path(t.spark, "facts")
    query = (
        simple.parsed_facts(streams.text_stream(t.spark, path))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", scratch_path(t.spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return t.spark.read.schema("fact string, length string").parquet(out)


register(
    "stream_parse_json",
    stream_parse_json,
    "SELECT text AS fact, CAST(length(text) AS VARCHAR) AS length FROM conversations",
)
