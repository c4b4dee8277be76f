"""Date classes, null handling, contracts and profiles."""

import datetime as dt

from pyspark.sql import functions as F

from patentloom import schemas
from patentloom.functions import dates
from patentloom.operators import quality

DATES = ["2020-01-15", "2020-13-45", "2021-02-30", "", "1074-05-01", None, "2020-1-5", "1999-12-31"]


def frame(spark):
    return spark.createDataFrame([(i, d) for i, d in enumerate(DATES)], "id int, d string")


def test_date_status_separates_what_a_parsed_column_cannot(spark, rows):
    assert dict(rows(quality.date_quality(frame(spark), "d"))) == {
        "valid": 3, "malformed": 2, "missing": 2, "out_of_range": 1,
    }


def test_valid_dates_are_parsed(spark):
    kept = quality.with_valid_dates(frame(spark), "d").orderBy("id").collect()
    assert [r.id for r in kept] == [0, 6, 7]
    assert kept[1].d == dt.date(2020, 1, 5)


def test_buckets_and_decades(spark):
    df = spark.createDataFrame([(dt.date(2019, 7, 23),)], "d date").select(
        dates.bucket_start(F.col("d"), "year"),
        dates.bucket_start(F.col("d"), "month"),
        dates.bucket_start(F.col("d"), "day"),
        dates.decade(F.year("d")),
    )
    assert tuple(df.first()) == (
        dt.date(2019, 1, 1), dt.date(2019, 7, 1), dt.date(2019, 7, 23), 2010,
    )


def test_null_and_blank_filters(spark):
    df = spark.createDataFrame(
        [("a", "x"), (None, "x"), ("", "y"), ("  ", "z"), ("b", None)], "k string, v string"
    )
    assert quality.require(df, "k").count() == 4
    assert quality.require(df, "k", "v").count() == 3
    assert [r.k for r in quality.require_text(df, "k").orderBy("k").collect()] == ["a", "b"]
    assert quality.drop_any_null(df).count() == 3
    assert quality.fill_defaults(df, {"k": "U"}).where("k = 'U'").count() == 1
    assert quality.drop_columns(df, ["v", "absent"]).columns == ["k"]


def test_conform_sets_order_and_types(spark):
    df = spark.createDataFrame(
        [(3, "b", 1.5, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1))],
        "grant_count long, branch string, avg_claims double, year date, timestamp timestamp",
    )
    assert quality.conform(df, schemas.PATENT_TRENDS).schema == schemas.PATENT_TRENDS


def test_profile_exact_and_approximate(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "n int, s string")
    expected = [("n", 3, 0, 2), ("s", 3, 1, 1)]
    assert rows(quality.profile(df)) == expected
    assert rows(quality.profile(df, distinct="approx")) == expected


def test_observed_counts_without_a_second_pass(spark):
    df, observation = quality.observed(spark.range(7), "loaded")
    assert df.where("id > 4").count() == 2
    assert observation.get == {"row_count": 7}


def test_inventors_without_a_place_are_kept_and_spread(spark, plan_of):
    from patentloom.plans.curate import inventor_info

    people = spark.createDataFrame(
        [("1", "a", None), ("1", "a", None), ("2", "b", "L1"), ("3", "c", "L9"), ("4", "d", "L1")],
        "patent_id string, inventor_id string, location_id string",
    )
    places = spark.createDataFrame(
        [("L1", "Rome", "1", "2"), (None, "Nowhere", "1", "2"), ("L2", "Bern", "1", "2")],
        "location_id string, disambig_city string, state_fips string, county_fips string",
    )
    df = inventor_info(people, places)
    assert df.columns == ["location_id", "patent_id", "inventor_id", "disambig_city"]
    got = sorted(((r.patent_id, r.location_id, r.disambig_city) for r in df.collect()), key=repr)
    assert got == [
        ("1", None, None), ("1", None, None), ("2", "L1", "Rome"), ("3", "L9", None), ("4", "L1", "Rome"),
    ]
