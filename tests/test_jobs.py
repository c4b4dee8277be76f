"""Raw files to reports, and a stream that carries the trend tables on."""

import json

import pytest

from patentloom import jobs
from patentloom.catalog.tables import Tables
from patentloom.sources.streams import json_stream
from patentloom.streaming import trends

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    t = Tables(spark, SF_DIR)
    raw = {
        "g_application": t.raw_application,
        "g_patent": t.raw_patent,
        "g_cpc_current": t.cpc_info,
        "g_cpc_title": t.raw_cpc_title,
        "g_inventor_disambiguated": t.raw_inventor,
        "g_location_disambiguated": t.raw_location,
        "g_applicant_not_disambiguated": t.raw_applicant,
    }
    for name, df in raw.items():
        assert df.columns == jobs.RAW_FILES[name].names
        df.write.option("sep", "\t").option("header", True).csv(str(root / f"raw/{name}.tsv"))
    t.summaries.selectExpr("""concat('"', patent_id, '"\t', summary_text)""").write.text(
        str(root / "text")
    )
    curated, out = str(root / "curated"), str(root / "out")
    assert len(jobs.build_curated(spark, str(root / "raw"), curated)) == 9
    jobs.build_keywords(spark, str(root / "text"), curated)
    return root, jobs.build_reports(spark, curated, out, with_keywords=True)


def test_all_reports_are_written(spark, built):
    root, _ = built
    counts = {
        kind: len(list((root / "out" / kind).glob("*/_SUCCESS")))
        for kind in ["patents", "inventors", "applicants", "branches"]
    }
    assert counts == {"patents": 25, "inventors": 21, "applicants": 26, "branches": 5}
    types = spark.read.option("header", True).csv(str(root / "out/patents/common_patent_types"))
    expected = spark.read.parquet(str(root / "curated/patent_info")).count()
    assert sum(int(r["count"]) for r in types.collect()) == expected > 0
    top = spark.read.parquet(str(root / "out/branches/top_keywords"))
    assert top.columns == ["branch", "keyword", "keyword_count", "rank"] and top.count() > 0


def test_stream_carries_the_trend_tables_on(spark, built, tmp_path):
    _, tables = built
    before = tables["patent_trends"].read().count()
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "new.json").write_text(json.dumps({
        "patent_id": "new", "patent_date": "2030-01-15", "num_claims": "7", "branch": "New",
        "inventors": [{"inventor_name": "Ann", "gender": "F", "state": "CA"}],
        "applicants": [{"organization": "Org"}],
    }) + "\n")
    root = tables["patent_trends"].path.rsplit("/", 1)[0]
    for query in trends.start_all(
        json_stream(spark, str(feed)), root, str(tmp_path / "checkpoints"),
        available_now=True, state_partitions=2,
    ):
        query.awaitTermination()
    after = tables["patent_trends"].read()
    assert after.count() == before + 1
    assert after.where("branch = 'New'").first().avg_claims == 7.0
    assert tables["geo_distribution"].read().where("state = 'US-CA'").count() == 1
