"""Word counts, JSON lines and category prices as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom import schemas
from patentloom.operators.quality import drop_any_null
from patentloom.sinks.scoped import ScopedTable
from patentloom.sources.streams import parsed_only


def word_counts(lines: DataFrame) -> DataFrame:
    """Occurrences per word of a text stream; words are what single blanks separate."""
    words = lines.select(F.explode(F.split("value", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_table(spark: SparkSession, path: str, parts: int = 64) -> ScopedTable:
    """The table of ``word_counts``, in parts by hash: an update leaves words alone that share
    no part with those of the batch."""
    part = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("string")
    return ScopedTable(spark, path, ["word"], "count", part=part)


def parsed_facts(lines: DataFrame, schema: str = schemas.FACTS) -> DataFrame:
    """Columns of the JSON object on each line; the parser takes single quotes too."""
    return lines.select(F.from_json("value", schema).alias("data")).select("data.*")


def category_prices(records: DataFrame) -> DataFrame:
    """Complete rows per category and their mean price."""
    return (
        drop_any_null(parsed_only(records))
        .groupBy("category")
        .agg(F.count("id").alias("count"), F.avg("price").alias("avg_price"))
    )
