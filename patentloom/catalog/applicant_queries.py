"""Registered reports over applicants."""

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import joined, rounded
from patentloom.plans import applicants

PER_PATENT = (
    "SELECT patent_id, count(applicant_sequence) AS n FROM applicant_info GROUP BY patent_id"
)
DATED = "applicant_info JOIN patent_info USING (patent_id)"


def _count(table: str, keys: str, name: str, counted: str = "patent_id") -> str:
    return f"SELECT {keys}, count({counted}) AS {name} FROM {table} GROUP BY {keys}"


register(
    "collab_by_org",
    lambda t: applicants.collaborations_by_org(t.applicant_info),
    _count("named_applicants", "raw_applicant_organization", "total_collaborations"),
)
register(
    "avg_applicants_per_patent",
    lambda t: rounded(
        applicants.avg_per_patent(t.applicant_info), "average_applicants_per_patent"
    ),
    f"SELECT round(avg(n), 6) AS average_applicants_per_patent FROM ({PER_PATENT})",
)
register(
    "applicant_type_frequency",
    lambda t: applicants.type_frequency(t.applicant_info),
    _count("applicant_info", "applicant_type", "total_applicants", "applicant_sequence"),
)
register(
    "top_10_organizations",
    lambda t: applicants.top_organizations(t.applicant_info),
    """SELECT raw_applicant_organization, count(patent_id) AS patent_count
       FROM applicant_info WHERE trim(raw_applicant_organization) <> ''
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
register(
    "collab_stats",
    lambda t: rounded(applicants.collaboration_stats(t.applicant_info), "avg_collaborations"),
    """SELECT round(avg(n), 6) AS avg_collaborations, max(n) AS max_collaborations,
              min(n) AS min_collaborations
       FROM (SELECT count(patent_id) AS n FROM applicant_info
             WHERE raw_applicant_organization IS NOT NULL
             GROUP BY raw_applicant_organization)""",
)
register(
    "unique_applicants_by_org",
    lambda t: applicants.last_names_by_org(t.applicant_info),
    """SELECT DISTINCT raw_applicant_organization, raw_applicant_name_last
       FROM applicant_info WHERE raw_applicant_organization IS NOT NULL""",
)
register(
    "single_applicant_patents",
    lambda t: applicants.single_applicant_patents(t.applicant_info),
    f"""SELECT count(*) FILTER (WHERE n = 1) AS single_applicant_patent_count
        FROM ({PER_PATENT})""",
)
register(
    "applicant_type_distribution",
    lambda t: applicants.types_by_org(t.applicant_info),
    _count("applicant_info", "raw_applicant_organization, applicant_type", "patent_count"),
)
register(
    "top_applicants_by_collab",
    lambda t: applicants.top_people(t.applicant_info, name="total_collaborations"),
    _count(
        "named_applicants",
        "raw_applicant_name_first, raw_applicant_name_last",
        "total_collaborations",
    )
    + " ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
register(
    "patents_by_organization",
    lambda t: applicants.patents_by_org(t.applicant_info),
    """SELECT raw_applicant_organization, count(patent_id) AS patent_count
       FROM applicant_info WHERE trim(raw_applicant_organization) <> '' GROUP BY 1""",
)
register(
    "applicant_patents_per_date",
    lambda t: applicants.patents_by_date(t.applicant_info, t.patent_info),
    _count(DATED, "patent_date", "total_patents"),
)
register(
    "applicant_patents_per_year",
    lambda t: applicants.patents_by_year(t.applicant_info, t.patent_info),
    f"""SELECT CAST(year(patent_date) AS INTEGER) AS grant_year,
               count(patent_id) AS total_patents
        FROM {DATED} GROUP BY 1""",
)
for name, build, condition in [
    ("collab_single_details", applicants.single_details, "n = 1"),
    ("collab_multi_details", applicants.multi_details, "n > 1"),
]:
    register(
        name,
        lambda t, build=build: build(t.applicant_info),
        f"""SELECT a.patent_id, a.applicant_type, a.raw_applicant_organization,
                   c.n AS collaboration_count
            FROM applicant_info a JOIN ({PER_PATENT}) c ON a.patent_id = c.patent_id
            WHERE c.{condition}""",
    )
register(
    "org_unique_applicants",
    lambda t: applicants.distinct_people_by_org(t.applicant_info),
    _count(
        "named_applicants",
        "raw_applicant_organization",
        "unique_applicant_count",
        "DISTINCT raw_applicant_name_last",
    ),
)
register(
    "multi_applicant_patents",
    lambda t: applicants.multi_applicant_patents(t.applicant_info),
    f"""SELECT count(*) FILTER (WHERE n > 1) AS multi_applicant_patent_count
        FROM ({PER_PATENT})""",
)
register(
    "avg_name_length",
    lambda t: rounded(applicants.avg_name_length(t.applicant_info), "avg_name_length"),
    """SELECT round(avg(length(raw_applicant_name_first) + length(raw_applicant_name_last)), 6)
                  AS avg_name_length
       FROM applicant_info""",
)
register(
    "patents_per_applicant_type",
    lambda t: applicants.patents_by_type(t.applicant_info),
    _count("applicant_info", "applicant_type", "patent_count"),
)
register(
    "patents_by_date_type",
    lambda t: applicants.patents_by_date_and_type(t.applicant_info, t.patent_info),
    _count(DATED, "patent_date, applicant_type", "patent_count"),
)
register(
    "applicants_most_patents",
    lambda t: applicants.top_people(t.applicant_info),
    _count(
        "named_applicants", "raw_applicant_name_first, raw_applicant_name_last", "patent_count"
    )
    + " ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
for name, build, condition in [
    ("collab_person_single", applicants.people_seen_once, "= 1"),
    ("collab_person_multi", applicants.people_seen_often, "> 1"),
]:
    register(
        name,
        lambda t, build=build: build(t.applicant_info),
        _count(
            "named_applicants",
            "raw_applicant_name_first, raw_applicant_name_last, raw_applicant_organization",
            "collaboration_count",
        )
        + f" HAVING count(patent_id) {condition}",
    )
register(
    "collab_count_by_patent",
    lambda t: applicants.per_patent(t.applicant_info),
    _count("applicant_info", "patent_id", "collaboration_count", "applicant_sequence"),
)
register(
    "org_individual_applicants",
    lambda t: applicants.first_applicant_orgs(t.applicant_info),
    """SELECT raw_applicant_organization, count(patent_id) AS patent_count
       FROM applicant_info WHERE applicant_sequence = 1 GROUP BY 1""",
)
register(
    "applicants_across_years",
    lambda t: applicants.active_many_years(t.applicant_info, t.patent_info),
    f"""SELECT raw_applicant_name_first, raw_applicant_name_last,
               count(DISTINCT year(patent_date)) AS distinct_years
        FROM {DATED} GROUP BY 1, 2 HAVING count(DISTINCT year(patent_date)) > 1""",
)
register(
    "active_orgs_in_year",
    lambda t: applicants.active_orgs(t.applicant_info, t.patent_info),
    f"""SELECT raw_applicant_organization, count(patent_id) AS patent_count
        FROM {DATED} WHERE year(patent_date) = 2023 GROUP BY 1""",
)
