"""Branch rules, matching and assignment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patentloom.operators import classify

RULES = {"First": ["A01B", "G06F3/00"], "Second": ["A01B1/00", "G06F3/00"]}
CPC = [
    ("p1", "A01B", "A01B1/00"),  # subclass of First, group of Second
    ("p2", "G06F", "G06F3/00"),  # the same code in both branches
    ("p3", "H04W", "H04W4/00"),  # no branch
    ("p4", "A01B", "A01B9/00"),
    ("p4", "A01B", "A01B1/00"),
    ("p5", "G06F3/00", "G06F3/00"),  # group equal to subclass counts once
]


@pytest.fixture
def cpc(spark):
    return spark.createDataFrame(CPC, "patent_id string, cpc_subclass string, cpc_group string")


def test_shipped_rules():
    assert [len(codes) for codes in classify.BRANCH_RULES.values()] == [7, 10, 11, 11, 6]
    assert len(classify.LIVE_BRANCH_RULES) == 5


def test_matches_equal_the_or_join(spark, cpc, rows):
    table = classify.rule_table(spark, RULES)
    expected = cpc.join(
        table, (F.col("cpc_group") == F.col("code")) | (F.col("cpc_subclass") == F.col("code"))
    ).select("patent_id", "branch", "code")
    assert rows(classify.match_branches(cpc, RULES)) == rows(expected)


def test_matching_is_a_hash_join(cpc, plan_of):
    plan = plan_of(classify.match_branches(cpc, RULES))
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_assignment_takes_the_first_branch_then_code(cpc, rows):
    assert rows(classify.assign_branch(cpc, RULES)) == [
        ("p1", "First", "A01B"),
        ("p2", "First", "G06F3/00"),
        ("p4", "First", "A01B"),
        ("p5", "First", "G06F3/00"),
    ]


def test_assignment_shuffles_once(cpc, plan_of):
    plan = plan_of(classify.assign_branch(cpc, RULES))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan


def test_cutoff_is_exclusive_and_optional(spark, cpc):
    patents = spark.createDataFrame(
        [("p1", dt.date(2024, 7, 31)), ("p2", dt.date(2024, 8, 1)), ("p4", None)],
        "patent_id string, patent_date date",
    )
    kept = classify.filter_patents(patents, cpc, "2024-08-01", RULES)
    assert [r.patent_id for r in kept.collect()] == ["p1"]
    assert classify.filter_patents(patents, cpc, rules=RULES).count() == 3


def test_coverage_lists_rules_without_hits(cpc, rows):
    assert rows(classify.rule_coverage(cpc, {**RULES, "Third": ["Z1"]})) == [
        ("First", "A01B", 3),
        ("First", "G06F3/00", 2),
        ("Second", "A01B1/00", 2),
        ("Second", "G06F3/00", 2),
        ("Third", "Z1", 0),
    ]
