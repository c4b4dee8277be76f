"""Registered reports over patents."""

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import rounded
from patentloom.plans import fused, patents

register(
    "patents_by_decade",
    lambda t: patents.by_decade(t.patent_info),
    """SELECT CAST(grant_year // 10 * 10 AS INTEGER) AS decade, count(*) AS count
       FROM granted_patents GROUP BY 1""",
)
register(
    "common_patent_types",
    lambda t: patents.common_types(t.patent_info),
    "SELECT patent_type, count(*) AS count FROM granted_patents GROUP BY 1",
)
register(
    "patents_by_year",
    lambda t: patents.by_year(t.patent_info),
    "SELECT grant_year, count(*) AS count FROM granted_patents GROUP BY 1",
)
register(
    "avg_grant_time_by_type",
    lambda t: rounded(patents.avg_grant_time_by_type(t.patent_info), "avg_grant_time_days"),
    """SELECT patent_type, round(avg(grant_time_days), 6) AS avg_grant_time_days
       FROM timed_patents GROUP BY 1""",
)
register(
    "cpc_patent_counts",
    lambda t: patents.section_counts(t.cpc_info),
    """SELECT c.cpc_section, c.patent_count, s.section_description
       FROM (SELECT cpc_section, count(DISTINCT patent_id) AS patent_count
             FROM cpc_info GROUP BY 1) c
       LEFT JOIN cpc_section_names s ON c.cpc_section = s.cpc_section""",
)
register(
    "patent_type_claims",
    lambda t: rounded(patents.claims_by_type(t.patent_info), "avg_num_claims"),
    """SELECT patent_type, round(avg(num_claims), 6) AS avg_num_claims,
              count(patent_id) AS patent_count
       FROM patent_info GROUP BY 1""",
)
register(
    "filings_by_year",
    lambda t: patents.filings_by_year(t.patent_info),
    """SELECT CAST(year(filing_date) AS INTEGER) AS filing_year, count(*) AS count
       FROM timed_patents GROUP BY 1""",
)
register(
    "long_grant_patents",
    lambda t: patents.long_grants(t.patent_info),
    """SELECT patent_type, count(*) AS count FROM timed_patents
       WHERE grant_time_days > 1000 GROUP BY 1""",
)
register(
    "shortest_grant_cpc",
    lambda t: rounded(
        patents.shortest_grant_sections(t.patent_info, t.cpc_info), "avg_grant_time"
    ),
    """SELECT cpc_section, round(avg(grant_time_days), 6) AS avg_grant_time
       FROM timed_patents JOIN cpc_info USING (patent_id) GROUP BY 1""",
)
register(
    "avg_claims_cpc",
    lambda t: rounded(patents.avg_claims_by_section(t.patent_info, t.cpc_info), "avg_claims"),
    """SELECT cpc_section, round(avg(num_claims), 6) AS avg_claims
       FROM patent_info JOIN cpc_info USING (patent_id) GROUP BY 1""",
)
register(
    "median_grant_cpc",
    lambda t: patents.median_grant_by_section(t.patent_info, t.cpc_info),
    """SELECT cpc_section, quantile_disc(grant_time_days, 0.5) AS median_grant_time
       FROM timed_patents JOIN cpc_info USING (patent_id) GROUP BY 1""",
)
register(
    "zero_claims",
    lambda t: patents.zero_claims(t.patent_info),
    "SELECT count(*) FILTER (WHERE num_claims = 0) AS zero_claims FROM patent_info",
)
register(
    "top_3_cpc_proportion",
    lambda t: rounded(
        patents.top_section_share(t.cpc_info), "row_ratio_pct", "patent_share_pct"
    ),
    """WITH top_sections AS (
           SELECT cpc_section FROM cpc_info GROUP BY 1
           ORDER BY count(*) DESC, cpc_section LIMIT 3)
       SELECT round(count(*) FILTER (WHERE in_top) / count(DISTINCT patent_id) * 100.0, 6)
                  AS row_ratio_pct,
              round(count(DISTINCT CASE WHEN in_top THEN patent_id END)
                    / count(DISTINCT patent_id) * 100.0, 6) AS patent_share_pct
       FROM (SELECT patent_id, cpc_section IN (SELECT cpc_section FROM top_sections) AS in_top
             FROM cpc_info)""",
)
register(
    "max_claims_year",
    lambda t: patents.year_with_most_claims(t.patent_info),
    """SELECT grant_year, CAST(sum(num_claims) AS BIGINT) AS total_claims
       FROM granted_patents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
register(
    "claims_year_type",
    lambda t: patents.claims_by_year_and_type(t.patent_info),
    """SELECT grant_year, patent_type, CAST(sum(num_claims) AS BIGINT) AS total_claims
       FROM granted_patents GROUP BY 1, 2""",
)
register(
    "longest_grant_time",
    lambda t: patents.longest_grant_times(t.patent_info),
    "SELECT * FROM timed_patents ORDER BY grant_time_days DESC, patent_id LIMIT 10",
)
register(
    "patents_by_country",
    lambda t: patents.by_country(t.patent_info, t.inventor_info),
    """SELECT disambig_country AS country, count(DISTINCT patent_id) AS count
       FROM timed_patents JOIN inventor_info USING (patent_id) GROUP BY 1""",
)
register(
    "type_by_decade",
    lambda t: patents.types_by_decade(t.patent_info),
    """SELECT CAST(grant_year // 10 * 10 AS INTEGER) AS decade, patent_type, count(*) AS count
       FROM granted_patents GROUP BY 1, 2""",
)
register(
    "trending_cpc",
    lambda t: patents.sections_by_decade(t.patent_info, t.cpc_info),
    """SELECT cpc_section, CAST(grant_year // 10 * 10 AS INTEGER) AS decade, count(*) AS count
       FROM timed_patents JOIN cpc_info USING (patent_id) GROUP BY 1, 2""",
)
register(
    "trending_cpc_top5",
    lambda t: rounded(patents.rising_sections(t.patent_info, t.cpc_info), "avg_change"),
    """WITH decades AS (
           SELECT cpc_section, grant_year // 10 * 10 AS decade, count(*) AS n
           FROM timed_patents JOIN cpc_info USING (patent_id) GROUP BY 1, 2),
       changes AS (
           SELECT *, n - lag(n) OVER (PARTITION BY cpc_section ORDER BY decade) AS change
           FROM decades)
       SELECT cpc_section, count(*) AS decades, CAST(sum(n) AS BIGINT) AS total,
              round(avg(change), 6) AS avg_change
       FROM changes GROUP BY 1 HAVING avg(change) > 0
       ORDER BY avg(change) DESC, cpc_section LIMIT 5""",
)
register(
    "longest_grant_country",
    lambda t: patents.longest_grant_by_country(t.patent_info, t.inventor_info),
    """SELECT disambig_country AS country, max(grant_time_days) AS longest_grant_time
       FROM timed_patents JOIN inventor_info USING (patent_id) GROUP BY 1""",
)
register(
    "under_year_pct",
    lambda t: rounded(patents.granted_within(t.patent_info), "under_year_pct"),
    """SELECT round(count(*) FILTER (WHERE grant_time_days < 365) / count(*) * 100.0, 6)
                  AS under_year_pct
       FROM timed_patents""",
)
register(
    "claims_distribution",
    lambda t: rounded(patents.claims_distribution(t.patent_info), "avg_claims"),
    """SELECT grant_year, min(num_claims) AS min_claims, max(num_claims) AS max_claims,
              round(avg(num_claims), 6) AS avg_claims
       FROM granted_patents GROUP BY 1""",
)
register(
    "avg_claims_filing",
    lambda t: rounded(patents.avg_claims_by_filing_year(t.patent_info), "avg_claims"),
    """SELECT CAST(year(filing_date) AS INTEGER) AS filing_year,
              round(avg(num_claims), 6) AS avg_claims
       FROM timed_patents GROUP BY 1""",
)
register(
    "grant_claim_corr",
    lambda t: rounded(patents.grant_claim_correlation(t.patent_info), "correlation"),
    "SELECT round(corr(grant_time_days, num_claims), 6) AS correlation FROM timed_patents",
)

# --- cells that many reports share -------------------------------------------------

FACTS = """facts AS (
        SELECT patent_id, patent_type, num_claims, patent_date IS NOT NULL AS granted,
               patent_date IS NOT NULL AND filing_date IS NOT NULL AS timed,
               CAST(year(patent_date) AS INTEGER) AS grant_year,
               CAST(year(patent_date) // 10 * 10 AS INTEGER) AS decade,
               CASE WHEN patent_date IS NOT NULL THEN CAST(year(filing_date) AS INTEGER) END AS filing_year,
               CASE WHEN patent_date IS NOT NULL
                    THEN CAST(date_diff('day', filing_date, patent_date) AS INTEGER) END AS days
        FROM patent_info)"""
register(
    "fused_patent_cells",
    lambda t: rounded(
        fused.patent_cells(t.patent_info),
        "avg_claims_of_all", "avg_claims", "avg_days", "fast", "avg_timed_claims", "correlation",
    ),
    f"""WITH {FACTS}
        SELECT grant_year, decade, patent_type, filing_year,
               grouping(grant_year, decade, patent_type, filing_year) AS set_id,
               count(patent_id) AS patents, round(avg(num_claims), 6) AS avg_claims_of_all,
               count(*) FILTER (WHERE num_claims = 0) AS zero_claims,
               count(*) FILTER (WHERE granted) AS granted,
               CAST(sum(num_claims) FILTER (WHERE granted) AS BIGINT) AS claims,
               min(num_claims) FILTER (WHERE granted) AS min_claims,
               max(num_claims) FILTER (WHERE granted) AS max_claims,
               round(avg(num_claims) FILTER (WHERE granted), 6) AS avg_claims,
               count(*) FILTER (WHERE timed) AS timed, round(avg(days), 6) AS avg_days,
               count(*) FILTER (WHERE days > 1000) AS slow,
               round(avg(CASE WHEN days < 365 THEN 1.0::DOUBLE WHEN timed THEN 0.0::DOUBLE END), 6) AS fast,
               round(avg(num_claims) FILTER (WHERE timed), 6) AS avg_timed_claims,
               round(corr(days, num_claims) FILTER (WHERE timed), 6) AS correlation
        FROM facts
        GROUP BY GROUPING SETS ((grant_year), (decade), (patent_type), (decade, patent_type),
                                (grant_year, patent_type), (filing_year), ())""",
)
register(
    "fused_section_cells",
    lambda t: rounded(
        fused.section_cells(t.patent_info, t.cpc_info), "avg_claims", "avg_days"
    ),
    f"""WITH {FACTS},
        joined AS (
            SELECT f.* REPLACE (CASE WHEN timed THEN decade END AS decade), cpc_section
            FROM facts f JOIN cpc_info USING (patent_id))
        SELECT cpc_section, decade, grouping(cpc_section, decade) AS set_id,
               round(avg(num_claims), 6) AS avg_claims, count(*) FILTER (WHERE timed) AS timed,
               round(avg(days), 6) AS avg_days, quantile_disc(days, 0.5) AS median_days
        FROM joined GROUP BY GROUPING SETS ((cpc_section), (cpc_section, decade))""",
)
