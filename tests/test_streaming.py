"""Streams over files dropped one by one."""

import json
import os

import pytest
from pyspark.sql import functions as F

from patentloom.sources import streams
from patentloom.streaming import guarded, simple, trends


def record(patent, date, branch="AI", claims="4", inventors=(("Ann", "F", "CA"),)):
    return {
        "patent_id": patent,
        "patent_date": date,
        "num_claims": claims,
        "branch": branch,
        "inventors": [
            {"inventor_name": n, "gender": g, "state": s} for n, g, s in inventors
        ],
        "applicants": [{"organization": "Org"}],
    }


class Feed:
    """A stream input folder whose files are read in the order they are added."""

    def __init__(self, path):
        self.path = path
        self.count = 0

    def add(self, *records, indent=None):
        self.count += 1
        target = self.path / f"{self.count:03}.json"
        if indent:
            target.write_text(json.dumps(list(records), indent=indent))
        else:
            target.write_text("".join(json.dumps(r) + "\n" for r in records))
        os.utime(target, (self.count, self.count))


@pytest.fixture
def feed(tmp_path):
    path = tmp_path / "feed"
    path.mkdir()
    return Feed(path)


def run(spark, feed, tmp_path, name, build, output_mode="update", delay="62 days", **source):
    table = trends.trend_tables(spark, str(tmp_path / "tables"))[name]
    records = streams.json_stream(spark, str(feed.path), files_per_trigger=1, **source)
    query = trends.start_upsert(
        build(trends.prepared(records, delay=delay)),
        table,
        str(tmp_path / "checkpoints" / name),
        output_mode=output_mode,
        available_now=True,
        state_partitions=2,
    )
    query.awaitTermination()
    return table, query


def grants(table):
    return sorted(
        (str(r.year), r.branch, r.grant_count, r.avg_claims) for r in table.read().collect()
    )


def test_update_mode_continues_from_its_checkpoint(spark, feed, tmp_path):
    feed.add(record("1", "2024-09-01", claims="2"), record("2", "2024-09-30", claims="4"))
    feed.add(record("3", "2024-10-05", "Net"), record("x", "2024-10-05", None))
    table, _ = run(spark, feed, tmp_path, "patent_trends", trends.patent_trends)
    assert grants(table) == [("2024-09-01", "AI", 2, 3.0), ("2024-10-01", "Net", 1, 4.0)]
    feed.add(record("4", "2024-09-15", claims="9"), record("5", "not a date"))
    table, _ = run(spark, feed, tmp_path, "patent_trends", trends.patent_trends)
    assert grants(table) == [("2024-09-01", "AI", 3, 5.0), ("2024-10-01", "Net", 1, 4.0)]
    version = table.read().inputFiles()
    table, _ = run(spark, feed, tmp_path, "patent_trends", trends.patent_trends)
    assert table.read().inputFiles() == version, "a run without input writes no version"


def late_feed(feed):
    feed.add(record("1", "2024-07-10"), record("2", "2024-07-20"))
    feed.add(record("3", "2024-08-02"), record("4", "2024-07-31"))
    feed.add(record("5", "2024-09-03"), record("6", "2024-07-01"), record("7", "2024-08-30"))
    feed.add(record("flush", "2025-06-01", "flush"))
    feed.add(record("end", "2025-06-02", "flush"))


def dropped(query):
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )


@pytest.mark.parametrize("delay, months", [("62 days", [4, 2, 1]), ("0 days", None)])
def test_append_mode_loses_only_what_the_delay_does_not_cover(
    spark, feed, tmp_path, delay, months
):
    late_feed(feed)
    table, query = run(
        spark, feed, tmp_path, "patent_trends", trends.patent_trends, "append", delay
    )
    counts = [r[2] for r in grants(table) if r[1] == "AI"]
    if months:
        assert counts == months and dropped(query) == 0
    else:
        assert sum(counts) < 7 and dropped(query) > 0


def test_gender_and_geo_count_inventor_rows(spark, feed, tmp_path):
    people = (("Ann", "F", "CA"), ("Bo", "M", "CA"), ("Cy", "U", "NY"))
    feed.add(record("1", "2024-09-01", inventors=people))
    feed.add(record("2", "2024-09-02", inventors=people[:1]))
    table, _ = run(spark, feed, tmp_path, "gender_trends", trends.gender_trends)
    assert [(r.male_count, r.female_count) for r in table.read().collect()] == [(1, 2)]
    table, _ = run(spark, feed, tmp_path, "geo_distribution", trends.geo_distribution)
    expected = {"US-CA": (3, 3), "US-NY": (1, 1)}
    assert {
        r.state: (r.inventor_count, r.patent_count) for r in table.read().collect()
    } == expected


def test_distinct_counting_with_a_sketch(spark, feed, tmp_path):
    people = (("Ann", "F", "CA"), ("Bo", "M", "CA"))
    feed.add(record("1", "2024-09-01", inventors=people))
    feed.add(record("2", "2024-09-02", inventors=people))
    table, _ = run(
        spark, feed, tmp_path, "geo_distribution",
        lambda ready: trends.geo_distribution(ready, prefix="", counting="approx_distinct"),
    )
    assert [tuple(r)[3:] for r in table.read().collect()] == [("CA", 2, 2)]


def test_exact_distinct_counts_and_their_state(spark, feed, tmp_path):
    ann, bo = ("Ann", "F", "CA"), ("Bo", "M", "CA")
    feed.add(record("1", "2024-09-01", inventors=(ann, bo, ann)))
    feed.add(record("2", "2024-09-02", inventors=(ann,)), record("1", "2024-09-01", inventors=(bo,)))
    feed.add(record("3", "2024-09-09", inventors=(ann, ("Cy", "M", "NY"))))
    distinct = lambda ready: trends.geo_distribution(ready, counting="distinct")
    table, query = run(spark, feed, tmp_path, "geo_distribution", distinct)
    expected = {"US-CA": (2, 3), "US-NY": (1, 1)}
    assert {r.state: (r.inventor_count, r.patent_count) for r in table.read().collect()} == expected
    rows = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    # Distinct (person or patent, state) values, and one row per state: not one per row read.
    assert max(rows) == 5 + 2 + 2
    feed.add(record("9", "2025-06-01", inventors=(ann,)))
    feed.add(record("10", "2025-06-02", inventors=(ann,)))
    table, query = run(spark, feed, tmp_path, "geo_distribution", distinct)
    last = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress][-1]
    assert last == 3 + 1, "closed months are forgotten"
    assert {r.state for r in table.read().collect()} == {"US-CA", "US-NY"}


def test_one_query_fills_the_three_tables(spark, feed, tmp_path):
    people = (("Ann", "F", "CA"), ("Bo", "M", "CA"), ("Cy", "U", None))
    feed.add(record("1", "2024-09-01", inventors=people), record("2", "2024-09-03", claims="x"))
    feed.add(record("3", "2024-10-01", "Net", inventors=()), record("4", "2024-09-05", inventors=people))
    queries = trends.start_all(
        streams.json_stream(spark, str(feed.path), files_per_trigger=1),
        str(tmp_path / "t"), str(tmp_path / "c"), available_now=True, state_partitions=2,
    )
    assert len(queries) == 1
    queries[0].awaitTermination()
    together = trends.trend_tables(spark, str(tmp_path / "t"))
    builds = {
        "patent_trends": trends.patent_trends,
        "gender_trends": trends.gender_trends,
        "geo_distribution": trends.geo_distribution,
    }
    for name, build in builds.items():
        alone, _ = run(spark, feed, tmp_path, name, build)
        columns = alone.read().columns
        want = sorted(map(tuple, alone.read().collect()), key=repr)
        assert sorted(map(tuple, together[name].read().select(columns).collect()), key=repr) == want
        assert want


def guarded_run(spark, feed, tmp_path, root="feed"):
    own = guarded.GuardedFeed.at(spark, str(tmp_path / root))
    query = trends.start_batches(
        streams.json_stream(spark, str(feed.path), files_per_trigger=1), own.take,
        str(tmp_path / f"{root}-checkpoint"), output_mode="append", available_now=True,
    )
    query.awaitTermination()
    return own


def reports_of(own):
    return sorted(
        (str(r.year), r.branch, r.grant_count, r.avg_claims, r.male_count, r.female_count, r.inventor_estimate)
        for r in own.trends().collect()
    )


def test_late_and_bad_rows_go_to_the_quarantine(spark, feed, tmp_path):
    ann, bo = ("Ann", "F", "CA"), ("Bo", "M", "CA")
    feed.add(record("1", "2024-03-01", inventors=(ann, bo)), record("2", "2024-03-09", claims="x"))
    feed.add(record("3", "2024-09-02", inventors=()), record("4", "2024-03-31"), record("5", "2024-02-30"))
    feed.add(record("6", "2024-09-02", None), record("7", "2024-07-15"), record("8", "2024-03-01"))
    (feed.path / "003.json").write_text((feed.path / "003.json").read_text() + "{broken\n")
    os.utime(feed.path / "003.json", (3, 3))
    own = guarded_run(spark, feed, tmp_path)
    rejected = sorted((r.batch_id, r.reason, r.patent_id) for r in own.rejected.read().collect() if r.patent_id)
    # The second batch came before September was the newest month: its March row counts.
    assert rejected == [(1, "undated", "5"), (2, "incomplete", "6"), (2, "late", "8")]
    counts = {(r.batch_id, r.reason): r.rows for r in own.rejections().collect()}
    assert counts[2, "malformed"] == 1
    want = [
        ("2024-03-01", "AI", 3, 4.0, 1, 3, 2),
        ("2024-07-01", "AI", 1, 4.0, 0, 1, 1),
        ("2024-09-01", "AI", 1, 4.0, 0, 0, 0),
    ]
    assert reports_of(own) == want
    # A replay of the last batch finds the same mark and overwrites its own folder.
    again = spark.read.schema(streams_schema()).option("columnNameOfCorruptRecord", streams.CORRUPT)
    own.take(again.json(str(feed.path / "003.json")), 2)
    assert reports_of(own) == want
    assert len(own.rejected.read().where("batch_id = 2").collect()) == 3


def streams_schema():
    from patentloom import schemas

    return f"{schemas.PATENT_STREAM}, {streams.CORRUPT} string"


def test_history_and_stream_unite_their_sketches(spark, tmp_path):
    def people(low, high):
        return spark.range(low, high).select(
            F.col("id").cast("string").alias("patent_id"), F.lit("2024-09-01").alias("patent_date"),
            F.lit("2").alias("num_claims"), F.lit("AI").alias("branch"),
            F.array(
                F.struct(F.concat(F.lit("p"), "id").alias("inventor_name"), F.lit("F").alias("gender"), F.lit("S").alias("state"))
            ).alias("inventors"),
            F.array(F.struct(F.lit("o").alias("organization"))).alias("applicants"),
        )

    both, whole = (guarded.GuardedFeed.at(spark, str(tmp_path / name)) for name in ("both", "whole"))
    both.start_from(people(0, 20_000))
    both.take(people(15_000, 40_000).withColumn(streams.CORRUPT, F.lit(None).cast("string")), 0)
    whole.start_from(people(0, 40_000))
    found, want = reports_of(both)[0], reports_of(whole)[0]
    assert found[2] == 45_000 and want[2] == 40_000
    assert found[6] == want[6], "the union of sketches is the sketch of the union"
    assert abs(found[6] - 40_000) < 4 * 40_000 * 1.04 / 2 ** (guarded.SKETCH / 2)


@pytest.mark.parametrize("multi_line", [True, False])
def test_indented_arrays_need_multi_line(spark, feed, tmp_path, multi_line):
    feed.add(record("1", "2024-09-01"), record("2", "2024-09-02"), indent=4)
    table, query = run(
        spark, feed, tmp_path, "patent_trends", trends.patent_trends, multi_line=multi_line
    )
    observed = [p["observedMetrics"]["parsing"] for p in query.recentProgress
                if "parsing" in p["observedMetrics"]]
    malformed = sum(m["malformed"] for m in observed)
    if multi_line:
        assert grants(table) == [("2024-09-01", "AI", 2, 4.0)] and malformed == 0
    else:
        assert not table.exists() and malformed > 2


def test_three_queries_share_one_input(spark, feed, tmp_path):
    feed.add(record("1", "2024-09-01"))
    queries = trends.start_all(
        streams.json_stream(spark, str(feed.path)),
        str(tmp_path / "t"),
        str(tmp_path / "c"),
        available_now=True,
        state_partitions=2,
    )
    for query in queries:
        query.awaitTermination()
    tables = trends.trend_tables(spark, str(tmp_path / "t"))
    assert [t.read().count() for t in tables.values()] == [1, 1, 1]


def test_json_lines_with_single_quotes(spark, tmp_path):
    lines = spark.createDataFrame(
        [("{'fact': 'Cats sleep', 'length': 10}",), ("broken",)], "value string"
    )
    assert sorted(map(tuple, simple.parsed_facts(lines).collect()), key=repr) == [
        ("Cats sleep", "10"), (None, None),
    ]


def test_category_prices_skip_incomplete_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a", 2.0, None), (2, "a", 4.0, None), (3, "a", None, None), (None, None, None, "x")],
        "id int, category string, price double, _corrupt_record string",
    )
    assert [tuple(r) for r in simple.category_prices(rows).collect()] == [("a", 2, 3.0)]


def test_an_update_of_word_counts_leaves_other_parts_alone(spark, tmp_path):
    table = simple.word_table(spark, str(tmp_path / "words"))
    words = spark.range(500).select(F.concat(F.lit("w"), "id").alias("value"))
    table.upsert(simple.word_counts(words))
    before = table.current_parts()
    table.upsert(spark.createDataFrame([("w7", 9), ("new", 1)], "word string, count long"))
    after = table.current_parts()
    assert 1 <= sum(after[p] != folder for p, folder in before.items()) <= 2
    got = {r.word: r["count"] for r in table.read().collect()}
    assert len(got) == 501 and got["w7"] == 9 and got["w8"] == 1


def test_word_counts_match_batch(spark):
    lines = spark.createDataFrame([("a b  a",), ("b",)], "value string")
    counts = simple.word_counts(lines).orderBy(F.col("word")).collect()
    assert [tuple(r) for r in counts] == [("", 1), ("a", 2), ("b", 2)]
