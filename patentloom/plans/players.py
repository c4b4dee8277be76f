"""Key players and key words per technology branch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom import schemas
from patentloom.functions.names import full_name, normalized_organization
from patentloom.operators.keywords import lemmatized
from patentloom.operators.quality import conform, require
from patentloom.operators.ranking import top_k_per_group

# Branches are few and large, so every report first counts per (branch, entity), a
# grouping that spreads, and only then ranks the counts inside a branch.


def _branch_rows(filtered: DataFrame, details: DataFrame) -> DataFrame:
    return details.join(filtered.select("patent_id", "branch"), "patent_id")


def top_inventors(filtered: DataFrame, inventors: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` inventors with most patents per branch; a move is a separate entry."""
    details = [
        "inventor_id", "disambig_inventor_name_first", "disambig_inventor_name_last",
        "gender_code", "latitude", "longitude", "disambig_state",
    ]
    counts = (
        _branch_rows(filtered, inventors.select("patent_id", *details))
        .groupBy("branch", *details)
        .agg(F.count("patent_id").alias("patent_count"))
    )
    order = [F.desc("patent_count"), *(F.asc_nulls_first(c) for c in details)]
    named = top_k_per_group(counts, "branch", order, k).select(
        "*",
        full_name(
            F.col("disambig_inventor_name_first"), F.col("disambig_inventor_name_last")
        ).alias("inventor_name"),
        F.col("gender_code").alias("gender"),
        F.col("disambig_state").alias("state"),
    )
    return conform(named, schemas.TOP_INVENTORS)


def top_applicants(filtered: DataFrame, applicants: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` organisations with most applications per branch, case folded."""
    rows = require(
        applicants.select("patent_id", "raw_applicant_organization"), "raw_applicant_organization"
    )
    counts = (
        _branch_rows(filtered, rows)
        .groupBy(
            "branch",
            normalized_organization(F.col("raw_applicant_organization")).alias("organization"),
        )
        .agg(F.count("patent_id").alias("patent_count"))
    )
    ranked = top_k_per_group(
        counts, "branch", [F.desc("patent_count"), F.asc("organization")], k
    )
    return conform(ranked, schemas.TOP_APPLICANTS)


def ranked_keywords(
    filtered: DataFrame, keywords: DataFrame, k: int = 50, lemmas: DataFrame | None = None
) -> DataFrame:
    """The ``k`` keywords per branch by count times total weight, with both parts."""
    entries = _branch_rows(filtered, keywords).select(
        "branch", F.explode("keywords").alias("entry")
    ).select("branch", F.col("entry._1").alias("keyword"), F.col("entry._2").alias("weight"))
    counts = (
        lemmatized(entries, "keyword", lemmas)
        .groupBy("branch", "normalized_keyword")
        .agg(
            F.count(F.lit(1)).alias("keyword_count"),
            # Decimal sums do not depend on the order in which tasks finish.
            F.sum(F.col("weight").cast("decimal(20,9)")).cast("double").alias("total_weight"),
        )
        .withColumn("ranking_metric", F.col("keyword_count") * F.col("total_weight"))
    )
    return top_k_per_group(
        counts, "branch", [F.desc("ranking_metric"), F.asc("normalized_keyword")], k
    )


def top_keywords(
    filtered: DataFrame, keywords: DataFrame, k: int = 50, lemmas: DataFrame | None = None
) -> DataFrame:
    ranked = ranked_keywords(filtered, keywords, k, lemmas)
    return conform(
        ranked.withColumnRenamed("normalized_keyword", "keyword"), schemas.TOP_KEYWORDS
    )
