"""File outputs and keyed tables."""

import random

import pytest
from pyspark.errors import AnalysisException

from patentloom.sinks import files
from patentloom.sinks.keyed import KeyedTable


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("a", 1, ["x", "y"]), ("b", 2, [])], "k string, n int, words array<string>"
    )


def test_new_parquet_refuses_an_existing_path(df, tmp_path):
    path = str(tmp_path / "t")
    files.new_parquet(df, path)
    with pytest.raises(AnalysisException):
        files.new_parquet(df, path)
    files.overwrite_parquet(df, path)
    files.append_parquet(df, path)
    assert df.sparkSession.read.parquet(path).count() == 4


def test_csv_flattens_arrays_and_writes_the_asked_number_of_files(df, spark, tmp_path):
    path = str(tmp_path / "c")
    files.write_single_csv(df, path)
    assert len(list((tmp_path / "c").glob("part-*"))) == 1
    back = spark.read.option("header", True).csv(path).orderBy("k").collect()
    assert [(r.k, r.n, r.words) for r in back] == [("a", "1", "x|y"), ("b", "2", None)]
    files.write_csv(spark.range(100), str(tmp_path / "many"), files=8)
    assert len(list((tmp_path / "many").glob("part-*"))) == 8


def test_save_all_reports_every_failure_and_writes_the_rest(df, spark, tmp_path):
    bad = spark.sql("SELECT cast('x' AS int) AS n")
    with pytest.raises(RuntimeError, match="broken"):
        files.save_all({"broken": bad, "good": df}, str(tmp_path), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "good")).count() == 2


def test_monthly_json(spark, tmp_path):
    records = spark.createDataFrame(
        [("a", "2024-10-31"), ("b", "2024-10-01"), ("c", "2024-09-30")], "id string, d string"
    )
    files.write_monthly_json(records, str(tmp_path), "d")
    assert {p.name for p in tmp_path.iterdir() if p.is_dir()} == {
        "month=2024_Oct", "month=2024_Sep",
    }
    assert spark.read.json(str(tmp_path)).count() == 3


def test_bucketed_tables_join_without_a_shuffle(spark, plan_of):
    for name in ("left_t", "right_t"):
        files.save_bucketed(spark.range(1000).selectExpr("id", "id AS v"), name, "id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_t").join(spark.table("right_t"), "id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE left_t")
        spark.sql("DROP TABLE right_t")


SCHEMA = "k string, n int, note string"


def table_at(spark, path, **options):
    return KeyedTable(spark, str(path), ["k"], "n", **options)


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_upsert_replaces_adds_and_skips_null_keys(spark, tmp_path):
    table = table_at(spark, tmp_path)
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.insert(spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], SCHEMA))
    batch = spark.createDataFrame(
        [("a", 2, "low"), ("a", 3, "high"), (None, 9, "no key"), ("c", None, "new")], SCHEMA
    )
    table.upsert(batch)
    expected = [("a", 3, "high"), ("b", 1, "old"), ("c", None, "new")]
    assert content(table) == expected
    table.upsert(batch)
    assert content(table) == expected, "applying a batch twice changes the table"


def test_upsert_into_nothing_combines_the_batch(spark, tmp_path):
    table = table_at(spark, tmp_path)
    table.upsert(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], SCHEMA))
    assert content(table) == [("a", 2, "y")]


def test_batches_of_distinct_keys_commute(spark, tmp_path):
    rng = random.Random(3)
    batches = [[(f"{b}{i}", rng.randint(0, 9), "n") for i in range(5)] for b in "xyz"]
    results = []
    for order in (batches, batches[::-1]):
        table = table_at(spark, tmp_path / str(len(results)))
        for batch in order:
            table.upsert(spark.createDataFrame(batch, SCHEMA))
        results.append(content(table))
    assert results[0] == results[1] and len(results[0]) == 15


def test_uncommitted_version_is_invisible_and_overwritten(spark, tmp_path):
    table = table_at(spark, tmp_path)
    row = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    table.insert(row)
    broken = tmp_path / "version=00000002"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half a file")
    assert content(table) == [("a", 1, "x")]
    table.upsert(spark.createDataFrame([("b", 2, "y")], SCHEMA))
    assert content(table) == [("a", 1, "x"), ("b", 2, "y")]


def test_old_versions_are_removed_but_not_the_readers(spark, tmp_path):
    table = table_at(spark, tmp_path, keep_versions=2)
    for n in range(5):
        table.insert(spark.createDataFrame([("a", n, "x")], SCHEMA))
    assert sorted(p.name for p in tmp_path.glob("version=*")) == [
        "version=00000004", "version=00000005",
    ]


def test_one_key_per_table(spark, tmp_path):
    table_at(spark, tmp_path).insert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    other = KeyedTable(spark, str(tmp_path), ["note"], "n")
    with pytest.raises(ValueError, match="keyed by"):
        other.upsert(spark.createDataFrame([("b", 1, "y")], SCHEMA))
    with pytest.raises(ValueError, match="missing"):
        table_at(spark, tmp_path).upsert(spark.createDataFrame([("b",)], "k string"))


def test_intermediate_tables_go_when_they_are_used_up(spark, tmp_path):
    import os

    from patentloom.session import scratch_removed, shared_dir
    from patentloom.sinks.files import written

    def folders():
        return set(os.listdir(shared_dir(spark))) if os.path.isdir(shared_dir(spark)) else set()

    kept = written(spark.range(3), "kept")
    before = folders()
    with scratch_removed(spark):
        assert written(spark.range(5), "first").count() == 5
        with scratch_removed(spark):
            written(spark.range(6), "inner")
        assert len(folders() - before) == 1
    assert folders() == before and kept.count() == 3
    with pytest.raises(ZeroDivisionError), scratch_removed(spark):
        written(spark.range(2), "failed")
        1 / 0
    assert folders() == before
