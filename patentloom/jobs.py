"""The whole chain from raw bulk files to report tables.

Each step writes its tables and the next one reads them back, so every raw file is parsed
once and joins are planned on tables of known size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patentloom import schemas
from patentloom.operators import joins, keywords
from patentloom.operators.classify import BRANCH_RULES, Rules, filter_patents
from patentloom.plans import applicants, branches, curate, fused, inventors, patents, players
from patentloom.session import scratch_removed
from patentloom.sinks import files
from patentloom.sinks.keyed import KeyedTable
from patentloom.sources.tabular import read_tsv
from patentloom.sources.text import read_quoted_records
from patentloom.streaming.trends import trend_tables

# Names of the raw bulk files.
RAW_FILES = {
    "g_application": schemas.RAW_APPLICATION,
    "g_patent": schemas.RAW_PATENT,
    "g_cpc_current": schemas.RAW_CPC,
    "g_cpc_title": schemas.RAW_CPC_TITLE,
    "g_inventor_disambiguated": schemas.RAW_INVENTOR,
    "g_location_disambiguated": schemas.RAW_LOCATION,
    "g_applicant_not_disambiguated": schemas.RAW_APPLICANT,
}


def curated_tables(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """The curated tables from the tab-separated files below ``raw``."""
    t = {name: read_tsv(spark, f"{raw}/{name}.tsv", s) for name, s in RAW_FILES.items()}
    return {
        "patent_info": curate.patent_info(t["g_patent"], t["g_application"]),
        "cpc_info": curate.cpc_info(t["g_cpc_current"]),
        "cpc_section": curate.cpc_section(spark),
        "cpc_group": curate.cpc_dimension(t["g_cpc_title"], "group"),
        "cpc_subclass": curate.cpc_dimension(t["g_cpc_title"], "subclass"),
        "cpc_class": curate.cpc_dimension(t["g_cpc_title"], "class"),
        "inventor_info": curate.inventor_info(
            t["g_inventor_disambiguated"], t["g_location_disambiguated"]
        ),
        "applicant_info": curate.applicant_info(t["g_applicant_not_disambiguated"]),
    }


def build_curated(
    spark: SparkSession,
    raw: str,
    out: str,
    granted_before: str | None = None,
    rules: Rules = BRANCH_RULES,
) -> list[str]:
    """Write the curated tables and the branch-filtered patents below ``out``."""
    paths = files.save_all(curated_tables(spark, raw), out)
    filtered = filter_patents(
        spark.read.parquet(f"{out}/patent_info"),
        spark.read.parquet(f"{out}/cpc_info"),
        granted_before,
        rules,
    )
    return [*paths, *files.save_all({"filtered_patents": filtered}, out)]


def build_keywords(
    spark: SparkSession,
    text: str,
    curated: str,
    extract: Callable[[DataFrame], DataFrame] = keywords.keyword_table,
) -> None:
    """Write table ``keywords`` for the filtered patents from the record text files.

    ``extract`` gives (patent_id, keywords); the default ranks terms by tf-idf. For a
    language model pass ``embedding_keywords`` with a function that makes the model.
    """
    wanted = spark.read.parquet(f"{curated}/filtered_patents")
    with scratch_removed(spark):
        selected = joins.matching(read_quoted_records(spark, text), wanted, "patent_id")
        files.overwrite_parquet(extract(selected), f"{curated}/keywords")


def patent_reports(info: DataFrame, cpc: DataFrame, people: DataFrame) -> dict[str, DataFrame]:
    """Most of them from the stored cells of ``plans.fused``: see there for what is run at once."""
    return {
        **fused.reports(info, cpc),
        "cpc_patent_counts": patents.section_counts(cpc),
        "top_3_cpc_proportion": patents.top_section_share(cpc),
        "longest_grant_time": patents.longest_grant_times(info),
        "patents_by_country": patents.by_country(info, people),
        "longest_grant_country": patents.longest_grant_by_country(info, people),
    }


def inventor_reports(people: DataFrame, info: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_20_inventors": inventors.top_by_patents(people),
        "inventor_country_count": inventors.by_country(people),
        "inventor_state_count": inventors.by_state(people),
        "avg_patents_per_inventor": inventors.avg_patents_per_inventor(people),
        "total_patents_by_inventor": inventors.patents_per_inventor(people),
        "inventors_by_gender": inventors.by_gender(people),
        "patents_by_city": inventors.patents_by_city(people),
        "patents_by_state": inventors.patents_by_state(people),
        "patents_by_country": inventors.patents_by_country(people),
        "multi_country_inventors": inventors.in_many_countries(people),
        "avg_lat_lon": inventors.mean_position(people),
        "top_10_inventors_city": inventors.top_city_inventors(people),
        "top_inventors_per_city": inventors.top_inventors_per_city(people),
        "avg_patents_by_city": inventors.avg_patents_by_city(people),
        "fewest_patents_inventors": inventors.fewest_patents(people),
        "inventors_by_location": inventors.by_location(people),
        "gender_patent_count": inventors.patents_by_gender(people),
        "multi_year_inventors": inventors.active_many_years(people, info),
        "common_first_name_inventors": inventors.common_first_names(people),
        "recent_inventors": inventors.active_between(people, info),
        "top_10_countries_inventors": inventors.top_countries(people),
    }


def applicant_reports(rows: DataFrame, info: DataFrame) -> dict[str, DataFrame]:
    return {
        "collaboration_count_by_organization": applicants.collaborations_by_org(rows),
        "average_applicants_per_patent": applicants.avg_per_patent(rows),
        "applicant_type_frequency": applicants.type_frequency(rows),
        "top_10_organizations_by_patent_count": applicants.top_organizations(rows),
        "collaboration_statistics": applicants.collaboration_stats(rows),
        "unique_applicants_by_organization": applicants.last_names_by_org(rows),
        "single_applicant_patents": applicants.single_applicant_patents(rows),
        "applicant_type_distribution": applicants.types_by_org(rows),
        "top_applicants_by_collaborations": applicants.top_people(
            rows, name="total_collaborations"
        ),
        "top_organizations_by_patent_count": applicants.patents_by_org(rows),
        "patents_per_date": applicants.patents_by_date(rows, info),
        "patents_per_year": applicants.patents_by_year(rows, info),
        "collaboration_count_1_by_type": applicants.single_details(rows),
        "collaboration_count_gt1_by_type": applicants.multi_details(rows),
        "organizations_with_unique_applicants": applicants.distinct_people_by_org(rows),
        "multi_applicant_patents": applicants.multi_applicant_patents(rows),
        "average_applicant_name_length": applicants.avg_name_length(rows),
        "patents_per_applicant_type": applicants.patents_by_type(rows),
        "patents_by_date_and_applicant_type": applicants.patents_by_date_and_type(rows, info),
        "applicants_with_most_patents": applicants.top_people(rows),
        "collaboration_count_1": applicants.people_seen_once(rows),
        "collaboration_count_gt1": applicants.people_seen_often(rows),
        "collaboration_count_by_patent": applicants.per_patent(rows),
        "organizations_with_individual_applicants": applicants.first_applicant_orgs(rows),
        "applicants_with_patents_across_years": applicants.active_many_years(rows, info),
        "most_active_organizations_last_year": applicants.active_orgs(rows, info),
    }


def branch_reports(
    filtered: DataFrame, people: DataFrame, rows: DataFrame, words: DataFrame | None = None
) -> dict[str, DataFrame]:
    reports = {
        "trend_analytics": branches.yearly_overview(filtered, people),
        "geo_total": branches.geo_total(filtered, people),
        "top_inventors": players.top_inventors(filtered, people),
        "top_applicants": players.top_applicants(filtered, rows),
    }
    if words is not None:
        reports["top_keywords"] = players.top_keywords(filtered, words)
    return reports


def build_reports(
    spark: SparkSession, curated: str, out: str, with_keywords: bool = False
) -> dict[str, KeyedTable]:
    """Write all reports below ``out`` and return the keyed trend tables, which the
    streaming queries then keep current."""
    t = {
        name: spark.read.parquet(f"{curated}/{name}")
        for name in [
            "patent_info", "cpc_info", "inventor_info", "applicant_info", "filtered_patents",
        ]
    }
    info, people, rows = t["patent_info"], t["inventor_info"], t["applicant_info"]
    filtered = t["filtered_patents"]
    words = spark.read.parquet(f"{curated}/keywords") if with_keywords else None
    with scratch_removed(spark):
        files.save_all(patent_reports(info, t["cpc_info"], people), f"{out}/patents", "csv")
    files.save_all(inventor_reports(people, info), f"{out}/inventors", "csv")
    files.save_all(applicant_reports(rows, info), f"{out}/applicants", "csv")
    files.save_all(branch_reports(filtered, people, rows, words), f"{out}/branches")
    tables = trend_tables(spark, f"{out}/trends")
    tables["patent_trends"].insert(branches.patent_trends(filtered))
    tables["gender_trends"].insert(branches.gender_trends(filtered, people))
    tables["geo_distribution"].insert(branches.geo_distribution(filtered, people))
    return tables
