"""Reports over inventors and where they live."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom.operators.quality import require
from patentloom.operators.ranking import top_k, top_k_per_group

FIRST = "disambig_inventor_name_first"
LAST = "disambig_inventor_name_last"
CITY = "disambig_city"
STATE = "disambig_state"
COUNTRY = "disambig_country"


def named(inventors: DataFrame) -> DataFrame:
    return require(inventors, FIRST, LAST)


def _distinct_count(
    inventors: DataFrame, counted: str, name: str, *keys: str, approximate: bool = False
) -> DataFrame:
    """Distinct ``counted`` per key. Exact counts deduplicate in a shuffle by key and
    value, so a frequent key is spread over tasks before it is counted; approximate
    ones shuffle a fixed-size sketch per key and task instead."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return named(inventors).groupBy(*keys).agg(count(counted).alias(name))


def _patents(
    inventors: DataFrame, *keys: str, name: str = "patent_count", approximate: bool = False
) -> DataFrame:
    return _distinct_count(inventors, "patent_id", name, *keys, approximate=approximate)


def _people(
    inventors: DataFrame, *keys: str, name: str = "num_inventors", approximate: bool = False
) -> DataFrame:
    return _distinct_count(inventors, "inventor_id", name, *keys, approximate=approximate)


def _dated(inventors: DataFrame, patents: DataFrame) -> DataFrame:
    """Named inventors with the grant date of each of their patents."""
    return named(inventors).select("inventor_id", "patent_id").join(
        patents.select("patent_id", "patent_date"), "patent_id"
    )


def top_by_patents(inventors: DataFrame, k: int = 20) -> DataFrame:
    counts = _patents(inventors, "inventor_id", FIRST, LAST, name="distinct_patent_count")
    return top_k(
        counts,
        [F.desc("distinct_patent_count"), F.asc("inventor_id"), F.asc(FIRST), F.asc(LAST)],
        k,
    )


def by_country(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _people(inventors, COUNTRY, approximate=approximate)


def by_state(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _people(inventors, STATE, approximate=approximate)


def by_gender(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _people(inventors, "gender_code", approximate=approximate)


def by_location(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _people(inventors, CITY, STATE, COUNTRY, approximate=approximate)


def patents_per_inventor(inventors: DataFrame) -> DataFrame:
    return _patents(inventors, "inventor_id", name="distinct_patent_count")


def avg_patents_per_inventor(inventors: DataFrame) -> DataFrame:
    return patents_per_inventor(inventors).agg(
        F.avg("distinct_patent_count").alias("avg_patents_per_inventor")
    )


def patents_by_city(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _patents(inventors, CITY, approximate=approximate)


def patents_by_state(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _patents(inventors, STATE, approximate=approximate)


def patents_by_country(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _patents(inventors, COUNTRY, approximate=approximate)


def patents_by_gender(inventors: DataFrame, approximate: bool = False) -> DataFrame:
    return _patents(inventors, "gender_code", approximate=approximate)


def in_many_countries(inventors: DataFrame) -> DataFrame:
    """Inventors seen in more than one country, with the sorted countries.

    Pairs are deduplicated first; only the few distinct countries of an inventor
    reach the collected array.
    """
    pairs = require(named(inventors), COUNTRY).select("inventor_id", COUNTRY).distinct()
    return (
        pairs.groupBy("inventor_id")
        .agg(F.sort_array(F.collect_list(COUNTRY)).alias("countries"))
        .where(F.size("countries") > 1)
    )


def mean_position(inventors: DataFrame) -> DataFrame:
    return named(inventors).agg(
        F.avg("latitude").alias("avg_latitude"), F.avg("longitude").alias("avg_longitude")
    )


def top_city_inventors(inventors: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` (city, inventor) pairs with most patents overall."""
    counts = _patents(inventors, CITY, "inventor_id")
    return top_k(
        counts, [F.desc("patent_count"), F.asc_nulls_first(CITY), F.asc("inventor_id")], k
    )


def top_inventors_per_city(inventors: DataFrame, k: int = 10) -> DataFrame:
    counts = require(_patents(inventors, CITY, "inventor_id"), CITY)
    return top_k_per_group(counts, CITY, [F.desc("patent_count"), F.asc("inventor_id")], k)


def avg_patents_by_city(inventors: DataFrame) -> DataFrame:
    """Mean number of distinct patents an inventor of the city holds there."""
    return (
        _patents(inventors, CITY, "inventor_id")
        .groupBy(CITY)
        .agg(F.avg("patent_count").alias("avg_patent_count"))
    )


def fewest_patents(inventors: DataFrame, k: int = 10) -> DataFrame:
    counts = _patents(inventors, "inventor_id")
    return top_k(counts, [F.asc("patent_count"), F.asc("inventor_id")], k)


def active_many_years(inventors: DataFrame, patents: DataFrame) -> DataFrame:
    """Inventors with patents granted in more than one year."""
    return (
        _dated(inventors, patents)
        .groupBy("inventor_id")
        .agg(F.count_distinct(F.year("patent_date")).alias("distinct_years"))
        .where(F.col("distinct_years") > 1)
    )


def common_first_names(inventors: DataFrame, k: int = 10) -> DataFrame:
    counts = _people(inventors, FIRST, name="name_count")
    return top_k(counts, [F.desc("name_count"), F.asc(FIRST)], k)


def active_between(
    inventors: DataFrame, patents: DataFrame, start: str = "2018-01-01", end: str = "2023-12-31"
) -> DataFrame:
    """Patents per inventor granted from ``start`` to ``end``, both included."""
    in_range = patents.where(
        F.col("patent_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    return (
        _dated(inventors, in_range)
        .groupBy("inventor_id")
        .agg(F.count_distinct("patent_id").alias("patent_count"))
    )


def top_countries(inventors: DataFrame, k: int = 10) -> DataFrame:
    return top_k(
        by_country(inventors), [F.desc("num_inventors"), F.asc_nulls_first(COUNTRY)], k
    )
