"""Reports over patents and their classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentloom.functions.dates import decade, grant_days
from patentloom.operators.quality import require
from patentloom.operators.ranking import top_k
from patentloom.plans.curate import cpc_section


def granted(patents: DataFrame) -> DataFrame:
    """Patents with a grant date, and its year."""
    return require(patents, "patent_date").withColumn("grant_year", F.year("patent_date"))


def timed(patents: DataFrame) -> DataFrame:
    """Granted patents with a filing date, and the days between both."""
    return require(granted(patents), "filing_date").withColumn(
        "grant_time_days", grant_days(F.col("patent_date"), F.col("filing_date"))
    )


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def by_decade(patents: DataFrame) -> DataFrame:
    dated = granted(patents).withColumn("decade", decade(F.col("grant_year")))
    return _counted(dated, "decade").orderBy("decade")


def common_types(patents: DataFrame) -> DataFrame:
    return _counted(granted(patents), "patent_type").orderBy(F.desc("count"), "patent_type")


def by_year(patents: DataFrame) -> DataFrame:
    return _counted(granted(patents), "grant_year").orderBy("grant_year")


def avg_grant_time_by_type(patents: DataFrame) -> DataFrame:
    return timed(patents).groupBy("patent_type").agg(
        F.avg("grant_time_days").alias("avg_grant_time_days")
    )


def section_counts(cpc: DataFrame) -> DataFrame:
    """Distinct patents per classification section, with the section's meaning."""
    counts = cpc.groupBy("cpc_section").agg(F.count_distinct("patent_id").alias("patent_count"))
    return counts.join(F.broadcast(cpc_section(cpc.sparkSession)), "cpc_section", "left")


def claims_by_type(patents: DataFrame) -> DataFrame:
    return patents.groupBy("patent_type").agg(
        F.avg(F.col("num_claims").cast("int")).alias("avg_num_claims"),
        F.count("patent_id").alias("patent_count"),
    )


def filings_by_year(patents: DataFrame) -> DataFrame:
    filed = timed(patents).withColumn("filing_year", F.year("filing_date"))
    return _counted(filed, "filing_year").orderBy("filing_year")


def long_grants(patents: DataFrame, longer_than: int = 1000) -> DataFrame:
    return _counted(
        timed(patents).where(F.col("grant_time_days") > longer_than), "patent_type"
    )


def _sections_of(patents: DataFrame, cpc: DataFrame, *columns: str) -> DataFrame:
    """One row per classification row, with ``columns`` of its patent."""
    return patents.select("patent_id", *columns).join(
        cpc.select("patent_id", "cpc_section"), "patent_id"
    )


def shortest_grant_sections(patents: DataFrame, cpc: DataFrame) -> DataFrame:
    rows = _sections_of(timed(patents), cpc, "grant_time_days")
    return (
        rows.groupBy("cpc_section")
        .agg(F.avg("grant_time_days").alias("avg_grant_time"))
        .orderBy("avg_grant_time", "cpc_section")
    )


def avg_claims_by_section(patents: DataFrame, cpc: DataFrame) -> DataFrame:
    rows = _sections_of(patents, cpc, "num_claims")
    return rows.groupBy("cpc_section").agg(F.avg("num_claims").alias("avg_claims"))


def median_grant_by_section(
    patents: DataFrame, cpc: DataFrame, accuracy: int = 10_000
) -> DataFrame:
    """Approximate median from mergeable sketches; no group is ever sorted whole."""
    rows = _sections_of(timed(patents), cpc, "grant_time_days")
    return rows.groupBy("cpc_section").agg(
        F.percentile_approx("grant_time_days", 0.5, accuracy).alias("median_grant_time")
    )


def zero_claims(patents: DataFrame) -> DataFrame:
    return patents.agg(F.count_if(F.col("num_claims") == 0).alias("zero_claims"))


def top_section_share(cpc: DataFrame, k: int = 3) -> DataFrame:
    """How much of the patents the ``k`` sections with most rows cover.

    ``row_ratio_pct`` sets classification rows against patents and may exceed 100;
    ``patent_share_pct`` counts patents having at least one such row.
    """
    ranked = top_k(_counted(cpc, "cpc_section"), [F.desc("count"), F.asc("cpc_section")], k)
    leading = ranked.select("cpc_section", F.lit(1).alias("leading"))
    per_patent = (
        cpc.select("patent_id", "cpc_section")
        .join(F.broadcast(leading), "cpc_section", "left")
        .groupBy("patent_id")
        .agg(F.count("leading").alias("leading_rows"))
    )
    patents = F.count("patent_id")
    return per_patent.agg(
        (F.sum("leading_rows") / patents * 100).alias("row_ratio_pct"),
        (F.count_if(F.col("leading_rows") > 0) / patents * 100).alias("patent_share_pct"),
    )


def year_with_most_claims(patents: DataFrame) -> DataFrame:
    totals = granted(patents).groupBy("grant_year").agg(F.sum("num_claims").alias("total_claims"))
    return top_k(totals, [F.desc("total_claims"), F.asc("grant_year")], 1)


def claims_by_year_and_type(patents: DataFrame) -> DataFrame:
    return (
        granted(patents).groupBy("grant_year", "patent_type")
        .agg(F.sum("num_claims").alias("total_claims"))
    )


def longest_grant_times(patents: DataFrame, k: int = 10) -> DataFrame:
    return top_k(timed(patents), [F.desc("grant_time_days"), F.asc("patent_id")], k)


def _countries(inventors: DataFrame) -> DataFrame:
    return inventors.select("patent_id", "disambig_country").distinct()


def by_country(patents: DataFrame, inventors: DataFrame) -> DataFrame:
    """Dated patents per inventor country; a patent counts once per country."""
    dated = timed(patents).select("patent_id")
    return (
        _countries(inventors).join(dated, "patent_id")
        .groupBy(F.col("disambig_country").alias("country"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def longest_grant_by_country(patents: DataFrame, inventors: DataFrame) -> DataFrame:
    dated = timed(patents).select("patent_id", "grant_time_days")
    return (
        _countries(inventors).join(dated, "patent_id")
        .groupBy(F.col("disambig_country").alias("country"))
        .agg(F.max("grant_time_days").alias("longest_grant_time"))
    )


def types_by_decade(patents: DataFrame) -> DataFrame:
    dated = granted(patents).withColumn("decade", decade(F.col("grant_year")))
    return _counted(dated, "decade", "patent_type")


def sections_by_decade(patents: DataFrame, cpc: DataFrame) -> DataFrame:
    dated = timed(patents).withColumn("decade", decade(F.col("grant_year")))
    return _counted(_sections_of(dated, cpc, "decade"), "cpc_section", "decade")


def rising_sections(patents: DataFrame, cpc: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` sections with the greatest mean increase from decade to decade."""
    by_time = Window.partitionBy("cpc_section").orderBy("decade")
    change = F.col("count") - F.lag("count").over(by_time)
    growth = (
        sections_by_decade(patents, cpc).withColumn("change", change)
        .groupBy("cpc_section")
        .agg(
            F.count(F.lit(1)).alias("decades"),
            F.sum("count").alias("total"),
            F.avg("change").alias("avg_change"),
        )
        .where(F.col("avg_change") > 0)
    )
    return top_k(growth, [F.desc("avg_change"), F.asc("cpc_section")], k)


def granted_within(patents: DataFrame, days: int = 365) -> DataFrame:
    fast = F.when(F.col("grant_time_days") < days, 1.0).otherwise(0.0)
    return timed(patents).agg((F.avg(fast) * 100).alias("under_year_pct"))


def claims_distribution(patents: DataFrame) -> DataFrame:
    return granted(patents).groupBy("grant_year").agg(
        F.min("num_claims").alias("min_claims"),
        F.max("num_claims").alias("max_claims"),
        F.avg("num_claims").alias("avg_claims"),
    )


def avg_claims_by_filing_year(patents: DataFrame) -> DataFrame:
    filed = timed(patents).withColumn("filing_year", F.year("filing_date"))
    return filed.groupBy("filing_year").agg(F.avg("num_claims").alias("avg_claims"))


def grant_claim_correlation(patents: DataFrame) -> DataFrame:
    return timed(patents).agg(F.corr("grant_time_days", "num_claims").alias("correlation"))
