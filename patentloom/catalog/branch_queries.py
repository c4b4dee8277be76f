"""Registered queries on branches: rules, matching, trends and key players."""

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import rounded, zoneless
from patentloom.operators import classify
from patentloom.plans import branches, players

HITS = """
    SELECT c.patent_id, r.branch, r.code
    FROM cpc_info c JOIN {rules} r ON c.cpc_group = r.code OR c.cpc_subclass = r.code"""
INVENTORS = "inventor_info i JOIN filtered_patents p ON i.patent_id = p.patent_id"
APPLICANTS = "applicant_info a JOIN filtered_patents p ON a.patent_id = p.patent_id"
MONTH = "CAST(date_trunc('month', p.patent_date) AS DATE)"

register(
    "branch_rules",
    lambda t: classify.rule_coverage(t.cpc_info),
    """SELECT r.branch, r.code, count(h.patent_id) AS hit_count
       FROM branch_rules r LEFT JOIN branch_hits h ON r.branch = h.branch AND r.code = h.code
       GROUP BY 1, 2""",
)
register(
    "branch_match",
    lambda t: classify.match_branches(t.cpc_info),
    HITS.format(rules="branch_rules"),
)
register(
    "branch_match_alt_rules",
    lambda t: classify.match_branches(t.cpc_info, classify.LIVE_BRANCH_RULES),
    HITS.format(rules="live_branch_rules"),
)
register(
    "branch_assign_unique",
    lambda t: classify.assign_branch(t.cpc_info),
    "SELECT * FROM assigned_branch",
)
register("filtered_patents", lambda t: t.filtered_patents, "SELECT * FROM filtered_patents")
register(
    "patent_trends_monthly",
    lambda t: zoneless(
        rounded(branches.patent_trends(t.filtered_patents), "avg_claims"), "timestamp"
    ),
    f"""SELECT CAST({MONTH} AS TIMESTAMP) AS timestamp, {MONTH} AS year, branch,
               CAST(count(*) AS INTEGER) AS grant_count,
               round(CAST(CAST(avg(num_claims) AS FLOAT) AS DOUBLE), 6) AS avg_claims
        FROM filtered_patents p GROUP BY 1, 2, 3""",
)
GENDER = f"""
    SELECT CAST({MONTH} AS TIMESTAMP) AS timestamp, {MONTH} AS year, p.branch,
           CAST(count(*) FILTER (WHERE gender_code = 'M') AS INTEGER) AS male_count,
           CAST(count(*) FILTER (WHERE gender_code = 'F') AS INTEGER) AS female_count
    FROM {INVENTORS} GROUP BY 1, 2, 3"""
register(
    "gender_trends_monthly",
    lambda t: zoneless(
        branches.gender_trends(t.stored_filtered_patents, t.inventor_info), "timestamp"
    ),
    GENDER,
)
register(
    "gender_trends_months_with_men",
    lambda t: zoneless(
        branches.gender_trends(
            t.stored_filtered_patents, t.inventor_info, only_buckets_with_men=True
        ),
        "timestamp",
    ),
    GENDER + " HAVING count(*) FILTER (WHERE gender_code = 'M') > 0",
)
register(
    "geo_distribution_monthly",
    lambda t: zoneless(
        branches.geo_distribution(t.stored_filtered_patents, t.inventor_info), "timestamp"
    ),
    f"""SELECT CAST({MONTH} AS TIMESTAMP) AS timestamp, {MONTH} AS year, p.branch,
               'US-' || disambig_state AS state,
               CAST(count(DISTINCT inventor_id) AS INTEGER) AS inventor_count,
               CAST(count(DISTINCT i.patent_id) AS INTEGER) AS patent_count
        FROM {INVENTORS} WHERE disambig_state IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
register(
    "geo_distribution_total",
    lambda t: rounded(
        branches.geo_total(t.stored_filtered_patents, t.inventor_info), "latitude", "longitude"
    ),
    f"""SELECT p.branch, 'US-' || disambig_state AS state,
               round(avg(CAST(latitude AS DOUBLE)), 6) AS latitude,
               round(avg(CAST(longitude AS DOUBLE)), 6) AS longitude,
               CAST(count(DISTINCT inventor_id) AS INTEGER) AS inventor_count,
               CAST(count(DISTINCT i.patent_id) AS INTEGER) AS patent_count
        FROM {INVENTORS} GROUP BY 1, 2""",
)
register(
    "branch_trend_wide",
    lambda t: rounded(
        branches.yearly_overview(t.stored_filtered_patents, t.inventor_info), "avg_claims"
    ),
    f"""WITH granted AS (
            SELECT CAST(date_trunc('year', patent_date) AS DATE) AS year, branch,
                   count(*) AS n, avg(num_claims) AS claims
            FROM filtered_patents GROUP BY 1, 2),
        filed AS (
            SELECT CAST(date_trunc('year', filing_date) AS DATE) AS year, branch, count(*) AS n
            FROM filtered_patents GROUP BY 1, 2),
        people AS (
            SELECT CAST(date_trunc('year', p.patent_date) AS DATE) AS year, p.branch,
                   count(*) FILTER (WHERE gender_code = 'M') AS men,
                   count(*) FILTER (WHERE gender_code = 'F') AS women,
                   count(*) FILTER (WHERE gender_code IS NULL) AS unknown
            FROM {INVENTORS} GROUP BY 1, 2),
        both_counts AS (
            SELECT coalesce(g.year, f.year) AS year, coalesce(g.branch, f.branch) AS branch,
                   g.n AS grants, f.n AS filings, g.claims
            FROM granted g FULL JOIN filed f ON g.year = f.year AND g.branch = f.branch)
        SELECT b.year, b.branch, CAST(coalesce(grants, 0) AS INTEGER) AS grant_count,
               CAST(coalesce(filings, 0) AS INTEGER) AS filed_count,
               CAST(coalesce(men, 0) AS INTEGER) AS male_count,
               CAST(coalesce(women, 0) AS INTEGER) AS female_count,
               CAST(coalesce(unknown, 0) AS INTEGER) AS unknown_count,
               round(CAST(CAST(coalesce(claims, 0) AS FLOAT) AS DOUBLE), 6) AS avg_claims
        FROM both_counts b LEFT JOIN people p ON b.year = p.year AND b.branch = p.branch""",
)
register(
    "top_inventors_by_branch",
    lambda t: players.top_inventors(t.stored_filtered_patents, t.inventor_info),
    f"""WITH counts AS (
            SELECT p.branch, inventor_id, disambig_inventor_name_first AS first_name,
                   disambig_inventor_name_last AS last_name, gender_code,
                   latitude, longitude, disambig_state, count(*) AS n
            FROM {INVENTORS} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY branch
                ORDER BY n DESC, inventor_id, first_name NULLS FIRST, last_name NULLS FIRST,
                         gender_code NULLS FIRST, latitude NULLS FIRST,
                         longitude NULLS FIRST, disambig_state NULLS FIRST) AS place
            FROM counts)
        SELECT branch, inventor_id, first_name || ' ' || last_name AS inventor_name,
               gender_code AS gender, disambig_state AS state,
               CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
               CAST(n AS INTEGER) AS patent_count, CAST(place AS INTEGER) AS rank
        FROM ranked WHERE place <= 20""",
)
INITCAP = (
    "array_to_string(list_transform(string_split(lower(raw_applicant_organization), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)
register(
    "top_applicants_by_branch",
    lambda t: players.top_applicants(t.stored_filtered_patents, t.applicant_info),
    f"""WITH counts AS (
            SELECT p.branch, {INITCAP} AS organization, count(*) AS n
            FROM {APPLICANTS} WHERE raw_applicant_organization IS NOT NULL GROUP BY 1, 2),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY branch
                                         ORDER BY n DESC, organization) AS place
            FROM counts)
        SELECT branch, organization, CAST(n AS INTEGER) AS patent_count,
               CAST(place AS INTEGER) AS rank
        FROM ranked WHERE place <= 20""",
)
