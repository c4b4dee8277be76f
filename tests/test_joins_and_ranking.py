"""Lookups of uneven keys and top-k reports."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patentloom.operators import joins, ranking


def test_frequency_lookup_equals_the_plain_join(spark, rows):
    # One key holds a third of all facts, one fact has no lookup row, one key is null.
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") == 1, "absent")
        .when(F.col("id") == 2, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")))
        .alias("key"),
        "id",
    )
    lookup = facts.where("key <> 'absent'").groupBy("key").agg(F.count("*").alias("n"))
    expected = rows(facts.join(lookup, "key"))
    for hot_keys in (1, 5, 1000):
        got = joins.frequency_lookup(facts, lookup, "key", "n", ["n"], hot_keys)
        assert rows(got) == expected


def test_join_kinds(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, r string")
    assert len(rows(joins.inner(left, right, "k"))) == 4
    assert (1, "a", None) in rows(joins.left_outer(left, right, "k"))
    assert (3, None, "z") in rows(joins.full_outer(left, right, "k"))
    assert rows(joins.matching(left, right, "k")) == [(2, "b"), (2, "c")]
    assert rows(joins.without_match(left, right, "k")) == [(1, "a")]


def test_group_limit_runs_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = plan_of(ranking.top_k_per_group(df, "g", [F.desc("id")], 2))
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_is_a_take_ordered(spark, plan_of):
    assert "TakeOrderedAndProject" in plan_of(ranking.top_k(spark.range(9), [F.desc("id")], 3))


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=40),
    st.integers(1, 4),
)
def test_ranks_are_contiguous_and_ties_are_ordered(spark, pairs, k):
    data = [(g, v, i) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    got = ranking.top_k_per_group(df, "g", [F.desc("v"), F.asc("id")], k).collect()
    for group in {g for g, _ in pairs}:
        expected = sorted((r for r in data if r[0] == group), key=lambda r: (-r[1], r[2]))[:k]
        mine = sorted((r for r in got if r.g == group), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(expected) + 1))
        assert [r.id for r in mine] == [r[2] for r in expected]
