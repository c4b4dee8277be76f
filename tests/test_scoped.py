"""Tables in parts: what an upsert touches, replays, and failed writes."""

import os

import pytest
from pyspark.sql import functions as F

from patentloom.sinks.scoped import ScopedTable

SCHEMA = "year date, branch string, n int, note string"


def table(spark, tmp_path, **options):
    part = F.col("year").cast("string")
    return ScopedTable(spark, str(tmp_path / "t"), ["year", "branch"], "n", part=part, **options)


def rows_of(spark, *rows):
    return spark.createDataFrame(
        [(y, b, n, note) for y, b, n, note in rows],
        "year string, branch string, n int, note string",
    ).withColumn("year", F.col("year").cast("date"))


def content(t):
    return sorted((str(r.year), r.branch, r.n, r.note) for r in t.read().collect())


def files_by_part(t):
    return {p: sorted(os.listdir(f.removeprefix("file:"))) for p, f in t.current_parts().items()}


def test_an_upsert_leaves_other_parts_alone(spark, tmp_path):
    t = table(spark, tmp_path)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(rows_of(spark, ("2024-01-01", "a", 1, "x"), ("2024-02-01", "a", 2, None)))
    before = files_by_part(t)
    batch = rows_of(spark, ("2024-02-01", "b", 5, "y"), ("2024-02-01", "a", 1, "later"), (None, "a", 9, ""))
    t.upsert(batch)
    assert content(t) == [
        ("2024-01-01", "a", 1, "x"), ("2024-02-01", "a", 1, "later"), ("2024-02-01", "b", 5, "y"),
    ]
    after = files_by_part(t)
    assert after["2024-01-01"] == before["2024-01-01"]
    assert after["2024-02-01"] != before["2024-02-01"]
    once = content(t)
    t.upsert(batch)
    assert content(t) == once, "a replayed batch changes nothing"
    assert files_by_part(t)["2024-01-01"] == before["2024-01-01"]
    assert t.read().columns == ["year", "branch", "n", "note"]


def test_an_upsert_reads_only_the_parts_of_the_batch(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows_of(spark, *((f"2024-{m:02}-01", "a", m, None) for m in range(1, 13))))
    assert len(t.read(["2024-03-01", "2030-01-01"]).inputFiles()) == 1
    assert t.read(["2030-01-01"]).count() == 0
    t.upsert(rows_of(spark, ("2030-01-01", "new", 1, None)))
    assert t.read().count() == 13


def test_insert_replaces_and_old_versions_go(spark, tmp_path):
    t = table(spark, tmp_path, keep_versions=2)
    for n in range(6):
        t.upsert(rows_of(spark, (f"2024-0{n % 2 + 1}-01", "a", n, None)))
    assert len([f for f in os.listdir(tmp_path / "t") if "=" in f]) <= 3
    assert [r[2] for r in content(t)] == [4, 5]
    t.insert(rows_of(spark, ("2025-01-01", "z", 1, None)))
    assert content(t) == [("2025-01-01", "z", 1, None)]
    t.upsert(rows_of(spark, ("2024-01-01", "a", 7, None)))
    assert [r[2] for r in content(t)] == [7, 1]


def test_a_failed_write_is_not_seen(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows_of(spark, ("2024-01-01", "a", 1, None)))
    before = content(t)
    part = tmp_path / "t" / "some=00000002" / "part=2024-01-01"
    part.mkdir(parents=True)  # what a job leaves that never got to its marker
    assert content(t) == before
    t.upsert(rows_of(spark, ("2024-02-01", "b", 2, None)))
    assert [r[2] for r in content(t)] == [1, 2]


def test_other_keys_are_refused(spark, tmp_path):
    table(spark, tmp_path).upsert(rows_of(spark, ("2024-01-01", "a", 1, None)))
    other = ScopedTable(spark, str(tmp_path / "t"), ["year"], "n", part=F.col("year").cast("string"))
    with pytest.raises(ValueError):
        other.upsert(rows_of(spark, ("2024-01-01", "a", 1, None)))
