"""Every registered query against its SQL on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
import check
from patentloom.catalog import all_oracle_sql, all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = all_queries(), all_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.duckdb_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql_with_a_sound_plan(spark, con, plan_of, name):
    built = []

    def query(spark, sf_dir):
        built.append(QUERIES[name](spark, sf_dir))
        return built[0]

    # A few reports have no rows on tables this small; check.py wants rows at sf0.01.
    problem = check.compare(spark, con, SF_DIR, name, query, ORACLE[name], may_be_empty=True)
    assert problem == ""
    plan = plan_of(built[0])
    assert not re.search("CartesianProduct|NestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)
    assert "MapInPandas" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["timestamp", "year", "branch", "grant_count", "avg_claims"]
    assert df.count() > 0
