"""Reports on hand-made rows: ties, nulls and the cases a plain reading gets wrong."""

import datetime as dt

import pytest

from patentloom.plans import applicants, branches, inventors, patents, players

D = dt.date


@pytest.fixture
def filtered(spark):
    return spark.createDataFrame(
        [
            ("p1", "AI", D(2020, 1, 5), D(2018, 3, 1), 10),
            ("p2", "AI", D(2020, 1, 20), D(2019, 3, 1), 20),
            ("p3", "AI", D(2020, 2, 1), None, None),
            ("p4", "Net", D(2021, 2, 1), D(2020, 1, 1), 4),
        ],
        "patent_id string, branch string, patent_date date, filing_date date, num_claims int",
    )


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            ("p1", "i1", "Ada", "L", "F", "CA", 1.0, 2.0, "US", "X"),
            ("p1", "i2", "Alan", "T", "M", "CA", 1.0, 2.0, "US", "X"),
            ("p2", "i1", "Ada", "L", "F", "CA", 1.0, 2.0, "US", "X"),
            ("p3", "i3", "Grace", "H", "F", "NY", 3.0, 4.0, "US", "Y"),
            ("p4", "i4", None, "Q", None, None, None, None, "DE", None),
            ("p4", "i1", "Ada", "L", "F", "BW", 5.0, 6.0, "DE", "Z"),
        ],
        "patent_id string, inventor_id string, disambig_inventor_name_first string, "
        "disambig_inventor_name_last string, gender_code string, disambig_state string, "
        "latitude float, longitude float, disambig_country string, disambig_city string",
    )


def test_patent_trends(filtered):
    got = branches.patent_trends(filtered).orderBy("branch", "year").collect()
    assert [(r.year, r.branch, r.grant_count, r.avg_claims) for r in got] == [
        (D(2020, 1, 1), "AI", 2, 15.0),
        (D(2020, 2, 1), "AI", 1, None),
        (D(2021, 2, 1), "Net", 1, 4.0),
    ]


def test_gender_trends_keep_months_with_women_only(filtered, people):
    def counts(**options):
        trends = branches.gender_trends(filtered, people, **options)
        return sorted((r.year, r.branch, r.male_count, r.female_count) for r in trends.collect())

    assert counts() == [
        (D(2020, 1, 1), "AI", 1, 2),
        (D(2020, 2, 1), "AI", 0, 1),
        (D(2021, 2, 1), "Net", 0, 1),
    ]
    assert counts(only_buckets_with_men=True) == [(D(2020, 1, 1), "AI", 1, 2)]


def test_geo_distribution_counts_distinct_and_drops_unknown_states(filtered, people):
    got = branches.geo_distribution(filtered, people)
    assert sorted((r.state, r.inventor_count, r.patent_count) for r in got.collect()) == [
        ("US-BW", 1, 1), ("US-CA", 2, 2), ("US-NY", 1, 1),
    ]
    bare = branches.geo_distribution(filtered, people, prefix="")
    assert {r.state for r in bare.collect()} == {"BW", "CA", "NY"}
    # A sketch is exact on so few values.
    sketched = branches.geo_distribution(filtered, people, approximate=True)
    assert sorted(sketched.collect()) == sorted(got.collect())
    exact, approximate = (
        {tuple(r) for r in inventors.by_country(people, approximate=a).collect()}
        for a in (False, True)
    )
    assert exact == approximate == {("US", 3), ("DE", 1)}


def test_yearly_overview_covers_years_of_either_kind(filtered, people):
    got = {
        (r.year, r.branch): tuple(r)[2:]
        for r in branches.yearly_overview(filtered, people).collect()
    }
    assert got == {
        (D(2018, 1, 1), "AI"): (0, 1, 0, 0, 0, 0.0),
        (D(2019, 1, 1), "AI"): (0, 1, 0, 0, 0, 0.0),
        (D(2020, 1, 1), "AI"): (3, 0, 1, 3, 0, 15.0),
        (None, "AI"): (0, 1, 0, 0, 0, 0.0),
        (D(2020, 1, 1), "Net"): (0, 1, 0, 0, 0, 0.0),
        (D(2021, 1, 1), "Net"): (1, 0, 0, 1, 1, 4.0),
    }


def test_top_inventors_split_by_place_and_ties_by_id(filtered, people):
    got = players.top_inventors(filtered, people, k=2).orderBy("branch", "rank").collect()
    assert [(r.branch, r.inventor_id, r.patent_count, r.rank) for r in got] == [
        ("AI", "i1", 2, 1), ("AI", "i2", 1, 2), ("Net", "i1", 1, 1), ("Net", "i4", 1, 2),
    ]
    assert got[3].inventor_name is None


def test_top_applicants_fold_case(spark, filtered):
    orgs = spark.createDataFrame(
        [("p1", "ACME-works CO."), ("p2", "acme-WORKS co."), ("p3", "Zeta"), ("p3", None)],
        "patent_id string, raw_applicant_organization string",
    )
    got = players.top_applicants(filtered, orgs).orderBy("rank").collect()
    assert [(r.organization, r.patent_count) for r in got] == [("Acme-works Co.", 2), ("Zeta", 1)]


def test_top_keywords_rank_by_count_times_weight(spark, filtered):
    words = spark.createDataFrame(
        [
            ("p1", [("networks", 0.5), ("cell", 0.9), ("", 1.0)]),
            ("p2", [("network", 0.5)]),
            ("p9", [("elsewhere", 1.0)]),
        ],
        "patent_id string, keywords array<struct<_1: string, _2: double>>",
    )
    got = players.top_keywords(filtered, words).orderBy("rank").collect()
    assert [(r.keyword, r.keyword_count, r.rank) for r in got] == [
        ("network", 2, 1), ("cell", 1, 2),
    ]


def test_section_share_may_exceed_all_patents_by_rows(spark):
    cpc = spark.createDataFrame(
        [("p1", "A"), ("p1", "A"), ("p1", "B"), ("p2", "A"), ("p3", "C")],
        "patent_id string, cpc_section string",
    )
    got = patents.top_section_share(cpc, k=2).first()
    assert (round(got.row_ratio_pct, 3), round(got.patent_share_pct, 3)) == (133.333, 66.667)


def test_longest_grant_times_break_ties_by_id(spark):
    df = spark.createDataFrame(
        [(p, D(2020, 1, 1), D(2019, 1, 1)) for p in ("b", "a", "c")],
        "patent_id string, patent_date date, filing_date date",
    )
    got = patents.longest_grant_times(df, k=2).collect()
    assert [(r.patent_id, r.grant_time_days) for r in got] == [("a", 365), ("b", 365)]


def test_patents_count_once_per_country(filtered, people):
    got = patents.by_country(filtered, people).collect()
    assert {r.country: r["count"] for r in got} == {"US": 2, "DE": 1}


def test_rising_sections_leave_out_the_falling_ones(spark):
    years = {"A": [1990, 2000, 2001], "B": [1990, 1991, 2000]}
    rows = [(s, y, f"{s}{i}") for s, ys in years.items() for i, y in enumerate(ys)]
    granted = spark.createDataFrame(
        [(p, D(y, 6, 1), D(y, 1, 1)) for _, y, p in rows],
        "patent_id string, patent_date date, filing_date date",
    )
    cpc = spark.createDataFrame(
        [(p, s) for s, _, p in rows], "patent_id string, cpc_section string"
    )
    got = patents.rising_sections(granted, cpc).collect()
    assert [(r.cpc_section, r.avg_change) for r in got] == [("A", 1.0)]


def test_inventor_reports(filtered, people):
    multi = inventors.in_many_countries(people).collect()
    assert [(r.inventor_id, r.countries) for r in multi] == [("i1", ["DE", "US"])]
    years = inventors.active_many_years(people, filtered).collect()
    assert [(r.inventor_id, r.distinct_years) for r in years] == [("i1", 2)]
    by_city = inventors.avg_patents_by_city(people).collect()
    assert {r.disambig_city: r.avg_patent_count for r in by_city} == {"X": 1.5, "Y": 1, "Z": 1}
    active = inventors.active_between(people, filtered, "2020-01-20", "2020-02-01").collect()
    assert sorted((r.inventor_id, r.patent_count) for r in active) == [("i1", 1), ("i3", 1)]


@pytest.fixture
def claims(spark):
    return spark.createDataFrame(
        [
            ("p1", 0, "Ann", "A", "Org", "t"),
            ("p1", 1, "Bob", "B", "Org", "t"),
            ("p2", 0, "Ann", "A", "Org", "t"),
            ("p4", 0, "Ann", "A", "", "u"),
            ("p3", 0, None, "C", None, "u"),
        ],
        "patent_id string, applicant_sequence int, raw_applicant_name_first string, "
        "raw_applicant_name_last string, raw_applicant_organization string, "
        "applicant_type string",
    )


def test_last_names_are_distinct_rows(spark):
    rows = [("big", f"n{i % 40}") for i in range(100)] + [("small", "x"), ("small", None), (None, "y")]
    df = spark.createDataFrame(
        rows, "raw_applicant_organization string, raw_applicant_name_last string"
    )
    got = applicants.last_names_by_org(df).collect()
    assert len(got) == 42
    assert {r[1] for r in got if r[0] == "big"} == {f"n{i}" for i in range(40)}


def test_applicant_details_and_counts(claims, filtered):
    single = applicants.single_details(claims).collect()
    assert sorted(r.patent_id for r in single) == ["p2", "p3", "p4"]
    assert [r.collaboration_count for r in applicants.multi_details(claims).collect()] == [2, 2]
    assert applicants.single_applicant_patents(claims).first()[0] == 3
    assert applicants.multi_applicant_patents(claims).first()[0] == 1
    assert [r[0] for r in applicants.patents_by_org(claims).collect()] == ["Org"]
    years = applicants.active_many_years(claims, filtered).collect()
    assert [(r.raw_applicant_name_first, r.distinct_years) for r in years] == [("Ann", 2)]
    active = applicants.active_orgs(claims, filtered, 2020).collect()
    assert [(r[0], r.patent_count) for r in active] == [("Org", 3), (None, 1)]
