"""The tables of ``tables.py`` once more, written in SQL for the independent check."""

from __future__ import annotations

from patentloom.catalog.tables import (
    BAD_DATES,
    CODE_SLOTS,
    FIRST_NAMES,
    OTHER_SUBCLASSES,
    PERSON_NAMES,
    SEGMENTS,
    rule_groups,
)
from patentloom.operators.classify import BRANCH_RULES, LIVE_BRANCH_RULES
from patentloom.plans.curate import CPC_SECTIONS


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def rule_rows(rules) -> str:
    rows = [
        f"({position}, '{branch}', '{code}')"
        for position, (branch, codes) in enumerate(rules.items())
        for code in codes
    ]
    return (
        "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(branch_position, branch, code)"
    )


def cpc_codes(key: str) -> str:
    groups = rule_groups()
    return f"""
        CASE WHEN {key} % {CODE_SLOTS} < {len(groups)}
             THEN ({sql_list(groups)})[{key} % {CODE_SLOTS} + 1]
             ELSE ({sql_list(OTHER_SUBCLASSES)})[({key} % {CODE_SLOTS}) % {len(OTHER_SUBCLASSES)} + 1]
                  || CAST(({key} // {CODE_SLOTS}) % 40 + 1 AS VARCHAR) || '/00'
        END"""


def _bad_dates() -> str:
    whens = " ".join(
        f"WHEN o_orderkey % {modulus} = 0 THEN " + ("NULL" if bad == "n/a" else f"'{bad}'")
        for modulus, bad in BAD_DATES.items()
    )
    return f"CASE {whens} ELSE CAST(granted AS VARCHAR) END"


VIEWS: dict[str, str] = {
    "dated_orders": """
        SELECT *, CAST(filed + CAST(o_orderkey % 1400 + 100 AS INTEGER) AS DATE) AS granted
        FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) + INTERVAL 240 MONTH AS DATE) AS filed
              FROM orders)""",
    "raw_application": """
        SELECT 'A' || o_orderkey AS application_id, CAST(o_orderkey AS VARCHAR) AS patent_id,
               o_orderstatus AS patent_application_type,
               CASE WHEN o_orderkey % 71 = 0 THEN '2019-00-10' ELSE CAST(filed AS VARCHAR) END
                   AS filing_date,
               o_orderstatus AS series_code, CAST(o_orderkey % 2 AS INTEGER) AS rule_47_flag
        FROM dated_orders""",
    "raw_patent": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, o_orderpriority AS patent_type,
               {_bad_dates()} AS patent_date,
               'Order ' || o_orderkey AS patent_title, 'K' || (o_orderkey % 3) AS wipo_kind,
               CAST(floor(o_totalprice / 10000) AS INTEGER) AS num_claims,
               CAST(o_orderkey % 53 = 0 AS INTEGER) AS withdrawn, 'orders.xml' AS filename
        FROM dated_orders""",
    "patent_info": """
        SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, o_orderpriority AS patent_type,
               CASE WHEN o_orderkey % 101 <> 0 THEN granted END AS patent_date,
               'Order ' || o_orderkey AS patent_title,
               CAST(floor(o_totalprice / 10000) AS INTEGER) AS num_claims,
               'A' || o_orderkey AS application_id,
               CASE WHEN o_orderkey % 103 <> 0 THEN filed END AS filing_date,
               o_orderstatus AS series_code
        FROM dated_orders""",
    "cpc_info": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, l_linenumber AS cpc_sequence,
               substr(cpc_group, 1, 1) AS cpc_section, substr(cpc_group, 1, 3) AS cpc_class,
               substr(cpc_group, 1, 4) AS cpc_subclass, cpc_group,
               CASE WHEN l_linenumber = 1 THEN 'inventional' ELSE 'additional' END AS cpc_type
        FROM (SELECT l_orderkey, l_linenumber, {cpc_codes("l_partkey")} AS cpc_group
              FROM lineitem)""",
    "raw_cpc_title": f"""
        SELECT substr(cpc_group, 1, 4) AS cpc_subclass,
               'Subclass ' || substr(cpc_group, 1, 4) AS cpc_subclass_title,
               cpc_group, 'Group ' || cpc_group AS cpc_group_title,
               substr(cpc_group, 1, 3) AS cpc_class,
               'Class ' || substr(cpc_group, 1, 3) AS cpc_class_title
        FROM (SELECT {cpc_codes("p_partkey")} AS cpc_group FROM part)""",
    "cpc_section_names": "SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in CPC_SECTIONS.items())
    + ") AS v(cpc_section, section_description)",
    "branch_rules": rule_rows(BRANCH_RULES),
    "live_branch_rules": rule_rows(LIVE_BRANCH_RULES),
    "branch_hits": """
        SELECT c.patent_id, r.branch_position, r.branch, r.code
        FROM cpc_info c JOIN branch_rules r ON c.cpc_group = r.code OR c.cpc_subclass = r.code""",
    "assigned_branch": """
        SELECT patent_id, branch, code
        FROM (SELECT *, row_number() OVER (PARTITION BY patent_id
                                           ORDER BY branch_position, code) AS choice
              FROM branch_hits)
        WHERE choice = 1""",
    "filtered_patents": """
        SELECT p.*, a.branch, a.code
        FROM patent_info p JOIN assigned_branch a ON p.patent_id = a.patent_id
        WHERE p.patent_date < DATE '2024-08-01'""",
    "raw_inventor": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, l_linenumber AS inventor_sequence,
               'inv-' || l_partkey AS inventor_id,
               ({sql_list(FIRST_NAMES)})[l_partkey % {len(FIRST_NAMES)} + 1]
                   AS disambig_inventor_name_first,
               CASE WHEN l_partkey % 11 <> 0 THEN 'Last' || (l_partkey % 500) END
                   AS disambig_inventor_name_last,
               CASE l_partkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender_code,
               CASE WHEN l_suppkey % 29 <> 0 THEN 'loc-' || l_suppkey END AS location_id
        FROM lineitem""",
    "raw_location": """
        SELECT 'loc-' || s_suppkey AS location_id, n_name || '-' || (s_suppkey % 3) AS disambig_city,
               CASE WHEN s_suppkey % 13 <> 0 THEN n_name END AS disambig_state,
               r_name AS disambig_country,
               CAST(s_suppkey % 100 * 0.25 + 25 AS FLOAT) AS latitude,
               CAST(s_suppkey % 80 * -0.5 - 60 AS FLOAT) AS longitude,
               n_name || ' county' AS county, CAST(n_nationkey AS VARCHAR) AS state_fips,
               CAST(s_suppkey AS VARCHAR) AS county_fips
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "inventor_info": """
        SELECT i.*, l.disambig_city, l.disambig_state, l.disambig_country, l.latitude,
               l.longitude, l.county
        FROM raw_inventor i LEFT JOIN raw_location l ON i.location_id = l.location_id""",
    "named_inventors": """
        SELECT * FROM inventor_info
        WHERE disambig_inventor_name_first IS NOT NULL
          AND disambig_inventor_name_last IS NOT NULL""",
    "raw_applicant": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, 0 AS applicant_sequence,
               CASE WHEN o_custkey % 23 <> 0
                    THEN ({sql_list(PERSON_NAMES)})[o_custkey % {len(PERSON_NAMES)} + 1] END
                   AS raw_applicant_name_first,
               CASE WHEN o_custkey % 23 <> 0 THEN 'Cust' || (o_custkey % 700) END
                   AS raw_applicant_name_last,
               CASE WHEN o_custkey % 31 <> 0
                    THEN ({sql_list(SEGMENTS)})[o_custkey % {len(SEGMENTS)} + 1] END
                   AS raw_applicant_organization,
               'inventor' AS applicant_type, 'applicant' AS applicant_designation,
               'US' AS applicant_authority, CAST(o_custkey AS VARCHAR) AS rawlocation_id
        FROM orders
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), l_linenumber,
               CASE WHEN l_suppkey % 4 = 0 THEN 'Rep' END,
               CASE WHEN l_suppkey % 4 = 0 THEN 'Agent' || l_suppkey END,
               CASE WHEN l_suppkey % 17 = 0 THEN ''
                    WHEN l_suppkey % 19 = 0 THEN NULL
                    WHEN l_orderkey % 2 = 0
                    THEN upper('Supplier works-' || l_suppkey || ' co., ltd.')
                    ELSE lower('Supplier works-' || l_suppkey || ' co., ltd.') END,
               CASE WHEN l_suppkey % 6 = 0 THEN 'legal-representative'
                    WHEN l_suppkey % 6 <> 1 THEN 'applicant' END,
               'applicant', 'US', CAST(l_suppkey AS VARCHAR)
        FROM lineitem""",
    "applicant_info": """
        SELECT patent_id, applicant_sequence, raw_applicant_name_first, raw_applicant_name_last,
               raw_applicant_organization, applicant_type
        FROM raw_applicant""",
    "named_applicants": """
        SELECT * FROM applicant_info
        WHERE raw_applicant_name_first IS NOT NULL AND raw_applicant_name_last IS NOT NULL""",
    "granted_patents": """
        SELECT *, CAST(year(patent_date) AS INTEGER) AS grant_year
        FROM patent_info WHERE patent_date IS NOT NULL""",
    "timed_patents": """
        SELECT *, CAST(date_diff('day', filing_date, patent_date) AS INTEGER) AS grant_time_days
        FROM granted_patents WHERE filing_date IS NOT NULL""",
    "summaries": """
        SELECT CAST(doc_id AS VARCHAR) AS patent_id, text AS summary_text FROM documents""",
    "live_patents": """
        SELECT CAST(event_id AS VARCHAR) AS patent_id,
               CAST(CAST(ts AS DATE) + CAST(event_id % 300 AS INTEGER) AS DATE) AS patent_date,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_claims,
               CASE WHEN event_id % 113 <> 0 THEN event_type END AS branch, user_id
        FROM events""",
    "live_inventors": """
        SELECT patent_id, patent_date, branch,
               'person-' || ((user_id + i * 7) % 90) AS inventor_name,
               CASE (user_id + i) % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END AS gender,
               'S' || ((user_id + i) % 25) AS state
        FROM (SELECT *, unnest(range(0, user_id % 3 + 1)) AS i
              FROM live_patents WHERE branch IS NOT NULL)""",
}
