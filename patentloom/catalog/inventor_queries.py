"""Registered reports over inventors."""

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import joined, rounded
from patentloom.plans import inventors


def _distinct(keys: str, counted: str, name: str) -> str:
    return (
        f"SELECT {keys}, count(DISTINCT {counted}) AS {name} "
        f"FROM named_inventors GROUP BY {keys}"
    )


register(
    "top_20_inventors",
    lambda t: inventors.top_by_patents(t.inventor_info),
    _distinct(
        "inventor_id, disambig_inventor_name_first, disambig_inventor_name_last",
        "patent_id",
        "distinct_patent_count",
    )
    + " ORDER BY 4 DESC, 1, 2, 3 LIMIT 20",
)
register(
    "inventors_by_country",
    lambda t: inventors.by_country(t.inventor_info),
    _distinct("disambig_country", "inventor_id", "num_inventors"),
)
register(
    "inventors_by_state",
    lambda t: inventors.by_state(t.inventor_info),
    _distinct("disambig_state", "inventor_id", "num_inventors"),
)
register(
    "avg_patents_per_inventor",
    lambda t: rounded(
        inventors.avg_patents_per_inventor(t.inventor_info), "avg_patents_per_inventor"
    ),
    f"""SELECT round(avg(n), 6) AS avg_patents_per_inventor
        FROM ({_distinct("inventor_id", "patent_id", "n")})""",
)
register(
    "total_patents_by_inventor",
    lambda t: inventors.patents_per_inventor(t.inventor_info),
    _distinct("inventor_id", "patent_id", "distinct_patent_count"),
)
register(
    "inventors_by_gender",
    lambda t: inventors.by_gender(t.inventor_info),
    _distinct("gender_code", "inventor_id", "num_inventors"),
)
register(
    "inv_patents_by_city",
    lambda t: inventors.patents_by_city(t.inventor_info),
    _distinct("disambig_city", "patent_id", "patent_count"),
)
register(
    "inv_patents_by_state",
    lambda t: inventors.patents_by_state(t.inventor_info),
    _distinct("disambig_state", "patent_id", "patent_count"),
)
register(
    "inv_patents_by_country",
    lambda t: inventors.patents_by_country(t.inventor_info),
    _distinct("disambig_country", "patent_id", "patent_count"),
)
register(
    "multi_country_inventors",
    lambda t: joined(inventors.in_many_countries(t.inventor_info), "countries"),
    """SELECT inventor_id, string_agg(disambig_country, '|' ORDER BY disambig_country)
                  AS countries
       FROM (SELECT DISTINCT inventor_id, disambig_country FROM named_inventors
             WHERE disambig_country IS NOT NULL)
       GROUP BY 1 HAVING count(*) > 1""",
)
register(
    "avg_lat_lon",
    lambda t: rounded(
        inventors.mean_position(t.inventor_info), "avg_latitude", "avg_longitude"
    ),
    """SELECT round(avg(CAST(latitude AS DOUBLE)), 6) AS avg_latitude,
              round(avg(CAST(longitude AS DOUBLE)), 6) AS avg_longitude
       FROM named_inventors""",
)
register(
    "top_10_inventors_city",
    lambda t: inventors.top_city_inventors(t.inventor_info),
    _distinct("disambig_city, inventor_id", "patent_id", "patent_count")
    + " ORDER BY 3 DESC, 1 NULLS FIRST, 2 LIMIT 10",
)
register(
    "top_inventors_per_city",
    lambda t: inventors.top_inventors_per_city(t.inventor_info),
    f"""SELECT disambig_city, inventor_id, patent_count, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY disambig_city
                                           ORDER BY patent_count DESC, inventor_id) AS rank
              FROM ({_distinct("disambig_city, inventor_id", "patent_id", "patent_count")})
              WHERE disambig_city IS NOT NULL)
        WHERE rank <= 10""",
)
register(
    "avg_patents_by_city",
    lambda t: rounded(inventors.avg_patents_by_city(t.inventor_info), "avg_patent_count"),
    f"""SELECT disambig_city, round(avg(n), 6) AS avg_patent_count
        FROM ({_distinct("disambig_city, inventor_id", "patent_id", "n")}) GROUP BY 1""",
)
register(
    "fewest_patents",
    lambda t: inventors.fewest_patents(t.inventor_info),
    _distinct("inventor_id", "patent_id", "patent_count") + " ORDER BY 2, 1 LIMIT 10",
)
register(
    "inventors_by_location",
    lambda t: inventors.by_location(t.inventor_info),
    _distinct(
        "disambig_city, disambig_state, disambig_country", "inventor_id", "num_inventors"
    ),
)
register(
    "gender_patent_count",
    lambda t: inventors.patents_by_gender(t.inventor_info),
    _distinct("gender_code", "patent_id", "patent_count"),
)
register(
    "multi_year_inventors",
    lambda t: inventors.active_many_years(t.inventor_info, t.patent_info),
    """SELECT inventor_id, count(DISTINCT year(patent_date)) AS distinct_years
       FROM named_inventors JOIN patent_info USING (patent_id)
       GROUP BY 1 HAVING count(DISTINCT year(patent_date)) > 1""",
)
register(
    "common_first_names",
    lambda t: inventors.common_first_names(t.inventor_info),
    _distinct("disambig_inventor_name_first", "inventor_id", "name_count")
    + " ORDER BY 2 DESC, 1 LIMIT 10",
)
register(
    "recent_inventors",
    lambda t: inventors.active_between(t.inventor_info, t.patent_info),
    """SELECT inventor_id, count(DISTINCT patent_id) AS patent_count
       FROM named_inventors JOIN patent_info USING (patent_id)
       WHERE patent_date BETWEEN DATE '2018-01-01' AND DATE '2023-12-31' GROUP BY 1""",
)
register(
    "top_10_countries",
    lambda t: inventors.top_countries(t.inventor_info),
    _distinct("disambig_country", "inventor_id", "num_inventors")
    + " ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10",
)
