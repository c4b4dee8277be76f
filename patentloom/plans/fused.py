"""Twenty reports over patents from two aggregations.

One pass over the patents groups them by several sets of keys at once (``GROUPING SETS``), one
join with the classification does the same by section. The cells are a few rows per key,
stored once; a report picks those of its set. Results equal those of ``plans.patents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentloom.functions.dates import decade, grant_days
from patentloom.operators.ranking import top_k
from patentloom.sinks.files import written

KEYS = ["grant_year", "decade", "patent_type", "filing_year"]
SETS = [
    ["grant_year"], ["decade"], ["patent_type"], ["decade", "patent_type"],
    ["grant_year", "patent_type"], ["filing_year"], [],
]
SECTION_KEYS = ["cpc_section", "decade"]
SECTION_SETS = [["cpc_section"], ["cpc_section", "decade"]]
LONG_DAYS, FAST_DAYS = 1000, 365


def patent_facts(info: DataFrame) -> DataFrame:
    """Every patent with its keys; ``granted`` and ``timed`` tell which dates it has."""
    granted = F.col("patent_date").isNotNull()
    timed = granted & F.col("filing_date").isNotNull()
    year = F.year("patent_date")
    return info.select(
        "patent_id",
        "patent_type",
        "num_claims",
        granted.alias("granted"),
        timed.alias("timed"),
        year.alias("grant_year"),
        decade(year).alias("decade"),
        F.when(timed, F.year("filing_date")).alias("filing_year"),
        F.when(timed, grant_days(F.col("patent_date"), F.col("filing_date"))).alias("days"),
    )


def patent_cells(info: DataFrame) -> DataFrame:
    """Measures of all ``SETS``; ``set_id`` tells them apart."""
    sets = [[F.col(c) for c in keys] for keys in SETS]
    own = F.when(F.col("granted"), F.col("num_claims"))
    return patent_facts(info).groupingSets(sets, *KEYS).agg(
        F.grouping_id().alias("set_id"),
        F.count("patent_id").alias("patents"),
        F.avg("num_claims").alias("avg_claims_of_all"),
        F.count_if(F.col("num_claims") == 0).alias("zero_claims"),
        F.count_if("granted").alias("granted"),
        F.sum(own).alias("claims"),
        F.min(own).alias("min_claims"),
        F.max(own).alias("max_claims"),
        F.avg(own).alias("avg_claims"),
        F.count_if("timed").alias("timed"),
        F.avg("days").alias("avg_days"),
        F.count_if(F.col("days") > LONG_DAYS).alias("slow"),
        F.avg(F.when(F.col("days") < FAST_DAYS, 1.0).when(F.col("timed"), 0.0)).alias("fast"),
        F.avg(F.when(F.col("timed"), F.col("num_claims"))).alias("avg_timed_claims"),
        F.corr("days", F.when(F.col("timed"), F.col("num_claims"))).alias("correlation"),
    )


def section_cells(info: DataFrame, cpc: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Measures per section, and per section and decade, from one join."""
    rows = patent_facts(info).join(cpc.select("patent_id", "cpc_section"), "patent_id")
    rows = rows.withColumn("decade", F.when(F.col("timed"), F.col("decade")))
    sets = [[F.col(c) for c in keys] for keys in SECTION_SETS]
    return rows.groupingSets(sets, *SECTION_KEYS).agg(
        F.grouping_id().alias("set_id"),
        F.avg("num_claims").alias("avg_claims"),
        F.count_if("timed").alias("timed"),
        F.avg("days").alias("avg_days"),
        F.percentile_approx("days", 0.5, accuracy).alias("median_days"),
    )


def set_id(keys: list[str], all_keys: list[str]) -> int:
    """The grouping id of a set: a bit for each key that is not in it, the first highest."""
    return int("".join("0" if k in keys else "1" for k in all_keys), 2)


def patent_reports(cells: DataFrame) -> dict[str, DataFrame]:
    """Reports by name, each from the cells of one set."""

    def of(*keys: str) -> DataFrame:
        return cells.where(F.col("set_id") == set_id(list(keys), KEYS))

    def counted(measure: str, *keys: str) -> DataFrame:
        return of(*keys).where(F.col(measure) > 0).select(*keys, F.col(measure).alias("count"))

    totals = of("grant_year").where("granted > 0").select(
        "grant_year", F.col("claims").alias("total_claims")
    )
    return {
        "patents_by_decade": counted("granted", "decade").orderBy("decade"),
        "common_patent_types": counted("granted", "patent_type").orderBy(F.desc("count"), "patent_type"),
        "patent_trends": counted("granted", "grant_year").orderBy("grant_year"),
        "avg_grant_time_by_type": of("patent_type").where("timed > 0").select(
            "patent_type", F.col("avg_days").alias("avg_grant_time_days")
        ),
        "patent_type_claims": of("patent_type").select(
            "patent_type", F.col("avg_claims_of_all").alias("avg_num_claims"),
            F.col("patents").alias("patent_count"),
        ),
        "filings_by_year": counted("timed", "filing_year").orderBy("filing_year"),
        "long_grant_patents": counted("slow", "patent_type"),
        "zero_claims": of().select("zero_claims"),
        "max_claims_year": top_k(totals, [F.desc_nulls_last("total_claims"), F.asc("grant_year")], 1),
        "claims_year_type": of("grant_year", "patent_type").where("granted > 0").select(
            "grant_year", "patent_type", F.col("claims").alias("total_claims")
        ),
        "type_by_decade": counted("granted", "decade", "patent_type"),
        "under_year": of().select((F.col("fast") * 100).alias("under_year_pct")),
        "claims_distribution": of("grant_year").where("granted > 0").select(
            "grant_year", "min_claims", "max_claims", "avg_claims"
        ),
        "avg_claims_filing": of("filing_year").where("timed > 0").select(
            "filing_year", F.col("avg_timed_claims").alias("avg_claims")
        ),
        "grant_claim_corr": of().select("correlation"),
    }


def section_reports(cells: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """Reports per section, each from the cells of one set."""
    by_section = cells.where(F.col("set_id") == set_id(["cpc_section"], SECTION_KEYS))
    by_decade = cells.where((F.col("set_id") == set_id(SECTION_KEYS, SECTION_KEYS)) & (F.col("timed") > 0))
    trending = by_decade.select("cpc_section", "decade", F.col("timed").alias("count"))
    change = F.col("count") - F.lag("count").over(Window.partitionBy("cpc_section").orderBy("decade"))
    growth = trending.withColumn("change", change).groupBy("cpc_section").agg(
        F.count(F.lit(1)).alias("decades"),
        F.sum("count").alias("total"),
        F.avg("change").alias("avg_change"),
    )
    timed = by_section.where("timed > 0")
    return {
        "shortest_grant_cpc": timed.select("cpc_section", F.col("avg_days").alias("avg_grant_time"))
        .orderBy("avg_grant_time", "cpc_section"),
        "avg_claims_cpc": by_section.select("cpc_section", "avg_claims"),
        "median_grant_cpc": timed.select("cpc_section", F.col("median_days").alias("median_grant_time")),
        "trending_cpc": trending,
        "trending_cpc_top5": top_k(
            growth.where(F.col("avg_change") > 0), [F.desc("avg_change"), F.asc("cpc_section")], k
        ),
    }


def reports(info: DataFrame, cpc: DataFrame) -> dict[str, DataFrame]:
    """All of both, over stored cells: the patents are read twice, and joined once."""
    return {
        **patent_reports(written(patent_cells(info), "patent-cells")),
        **section_reports(written(section_cells(info, cpc), "section-cells")),
    }
