"""Physical plans: pushdown, pruning and reuse."""

import re

import pytest
from pyspark.sql import functions as F

from patentloom.catalog.tables import Tables
from patentloom.operators.classify import filter_patents
from patentloom.operators.keywords import tfidf_keywords
from patentloom.plans import branches

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def without_broadcast(spark):
    """Plans as they are when no table is small enough to be broadcast unasked."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_filters_and_columns_reach_the_scan(spark, tmp_path, plan_of):
    t = Tables(spark, SF_DIR)
    for name, df in {"p": t.patent_info, "c": t.cpc_info}.items():
        df.write.parquet(str(tmp_path / name))
    patents, cpc = (spark.read.parquet(str(tmp_path / n)) for n in "pc")
    filtered = filter_patents(patents, cpc, granted_before="2024-08-01")
    plan = plan_of(branches.patent_trends(filtered))
    assert "LessThan(patent_date,2024-08-01)" in plan
    assert "ReadSchema: struct<patent_id:string,patent_date:date,num_claims:int>" in plan
    assert "ReadSchema: struct<patent_id:string,cpc_subclass:string,cpc_group:string>" in plan


def test_terms_are_shuffled_once(spark, plan_of, without_broadcast):
    # More terms than are looked up as hot ones, so that both sides have rows.
    docs = spark.range(1500).select(
        F.col("id").cast("string").alias("patent_id"),
        F.concat(F.lit("cell w"), F.col("id").cast("string")).alias("summary_text"),
    )
    df = tfidf_keywords(docs)
    assert len(df.collect()) == 3000
    # Three uses of the terms by document, one of them computed.
    assert len(re.findall(r"ReusedExchange \[patent_id#\d+, term#\d+, count", plan_of(df))) == 2
