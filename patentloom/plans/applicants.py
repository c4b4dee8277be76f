"""Reports over applicants: people, organisations and their collaborations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.operators.joins import frequency_lookup
from patentloom.operators.quality import require, require_text
from patentloom.operators.ranking import top_k

FIRST = "raw_applicant_name_first"
LAST = "raw_applicant_name_last"
ORG = "raw_applicant_organization"
TYPE = "applicant_type"
SEQUENCE = "applicant_sequence"


def people(applicants: DataFrame) -> DataFrame:
    return require(applicants, FIRST, LAST)


def _patents(df: DataFrame, *keys: str, name: str = "patent_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("patent_id").alias(name))


def per_patent(applicants: DataFrame, name: str = "collaboration_count") -> DataFrame:
    """Applicants per patent."""
    return applicants.groupBy("patent_id").agg(F.count(SEQUENCE).alias(name))


def _dated(applicants: DataFrame, patents: DataFrame, *columns: str) -> DataFrame:
    return applicants.select("patent_id", *columns).join(
        patents.select("patent_id", "patent_date"), "patent_id"
    )


def collaborations_by_org(applicants: DataFrame) -> DataFrame:
    return _patents(people(applicants), ORG, name="total_collaborations").orderBy(
        F.desc("total_collaborations"), F.asc_nulls_first(ORG)
    )


def avg_per_patent(applicants: DataFrame) -> DataFrame:
    return per_patent(applicants, "applicant_count").agg(
        F.avg("applicant_count").alias("average_applicants_per_patent")
    )


def type_frequency(applicants: DataFrame) -> DataFrame:
    counts = applicants.groupBy(TYPE).agg(F.count(SEQUENCE).alias("total_applicants"))
    return counts.orderBy(F.desc("total_applicants"), F.asc_nulls_first(TYPE))


def patents_by_org(applicants: DataFrame) -> DataFrame:
    """Patents per organisation with a non-blank name, most first."""
    return _patents(require_text(applicants, ORG), ORG).orderBy(F.desc("patent_count"), ORG)


def top_organizations(applicants: DataFrame, k: int = 10) -> DataFrame:
    return top_k(
        _patents(require_text(applicants, ORG), ORG), [F.desc("patent_count"), F.asc(ORG)], k
    )


def collaboration_stats(applicants: DataFrame) -> DataFrame:
    totals = _patents(require(applicants, ORG), ORG, name="total_collaborations")
    return totals.agg(
        F.avg("total_collaborations").alias("avg_collaborations"),
        F.max("total_collaborations").alias("max_collaborations"),
        F.min("total_collaborations").alias("min_collaborations"),
    )


def last_names_by_org(applicants: DataFrame) -> DataFrame:
    """Distinct (organisation, last name) rows, whatever the size of an organisation."""
    return require(applicants, ORG).select(ORG, LAST).distinct()


def _patents_where(applicants: DataFrame, condition: Column, name: str) -> DataFrame:
    return per_patent(applicants, "applicant_count").agg(F.count_if(condition).alias(name))


def single_applicant_patents(applicants: DataFrame) -> DataFrame:
    return _patents_where(
        applicants, F.col("applicant_count") == 1, "single_applicant_patent_count"
    )


def multi_applicant_patents(applicants: DataFrame) -> DataFrame:
    return _patents_where(
        applicants, F.col("applicant_count") > 1, "multi_applicant_patent_count"
    )


def types_by_org(applicants: DataFrame) -> DataFrame:
    return _patents(applicants, ORG, TYPE)


def top_people(applicants: DataFrame, k: int = 10, name: str = "patent_count") -> DataFrame:
    """People named on most patents; ``name`` is the counting column."""
    return top_k(
        _patents(people(applicants), FIRST, LAST, name=name),
        [F.desc(name), F.asc(FIRST), F.asc(LAST)],
        k,
    )


def patents_by_date(applicants: DataFrame, patents: DataFrame) -> DataFrame:
    return _patents(
        _dated(applicants, patents), "patent_date", name="total_patents"
    ).orderBy("patent_date")


def patents_by_year(applicants: DataFrame, patents: DataFrame) -> DataFrame:
    dated = _dated(applicants, patents).withColumn("grant_year", F.year("patent_date"))
    return _patents(dated, "grant_year", name="total_patents").orderBy("grant_year")


def _details(applicants: DataFrame, condition: Column) -> DataFrame:
    """Applicant rows of the patents whose applicant count meets ``condition``.

    Counting and looking the count up, rather than a window over the patent, combines
    rows before the shuffle and keeps a patent with very many applicants spread out.
    """
    rows = applicants.select("patent_id", TYPE, ORG)
    count = "collaboration_count"
    return frequency_lookup(rows, per_patent(applicants), "patent_id", count, [count]).where(
        condition
    )


def single_details(applicants: DataFrame) -> DataFrame:
    return _details(applicants, F.col("collaboration_count") == 1)


def multi_details(applicants: DataFrame) -> DataFrame:
    return _details(applicants, F.col("collaboration_count") > 1)


def distinct_people_by_org(applicants: DataFrame) -> DataFrame:
    counts = people(applicants).groupBy(ORG).agg(
        F.count_distinct(LAST).alias("unique_applicant_count")
    )
    return counts.orderBy(F.desc("unique_applicant_count"), F.asc_nulls_first(ORG))


def avg_name_length(applicants: DataFrame) -> DataFrame:
    return applicants.agg(F.avg(F.length(FIRST) + F.length(LAST)).alias("avg_name_length"))


def patents_by_type(applicants: DataFrame) -> DataFrame:
    return _patents(applicants, TYPE).orderBy(F.desc("patent_count"), F.asc_nulls_first(TYPE))


def patents_by_date_and_type(applicants: DataFrame, patents: DataFrame) -> DataFrame:
    return _patents(_dated(applicants, patents, TYPE), "patent_date", TYPE)


def _collaborations(applicants: DataFrame) -> DataFrame:
    return _patents(people(applicants), FIRST, LAST, ORG, name="collaboration_count")


def people_seen_once(applicants: DataFrame) -> DataFrame:
    return _collaborations(applicants).where(F.col("collaboration_count") == 1)


def people_seen_often(applicants: DataFrame) -> DataFrame:
    return _collaborations(applicants).where(F.col("collaboration_count") > 1)


def first_applicant_orgs(applicants: DataFrame) -> DataFrame:
    return _patents(applicants.where(F.col(SEQUENCE) == 1), ORG)


def active_many_years(applicants: DataFrame, patents: DataFrame) -> DataFrame:
    """People with patents granted in more than one year."""
    return (
        _dated(applicants, patents, FIRST, LAST)
        .groupBy(FIRST, LAST)
        .agg(F.count_distinct(F.year("patent_date")).alias("distinct_years"))
        .where(F.col("distinct_years") > 1)
    )


def active_orgs(applicants: DataFrame, patents: DataFrame, year: int = 2023) -> DataFrame:
    """Organisations by patents granted in ``year``.

    The year is a date range, which the Parquet scan of ``patents`` can skip by.
    """
    first, last = (F.lit(f"{y}-01-01").cast("date") for y in (year, year + 1))
    granted = patents.where((F.col("patent_date") >= first) & (F.col("patent_date") < last))
    return _patents(_dated(applicants, granted, ORG), ORG).orderBy(
        F.desc("patent_count"), F.asc_nulls_first(ORG)
    )
