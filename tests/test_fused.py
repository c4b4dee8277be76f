"""Fused reports equal the reports one by one, from few scans and one join."""

import re

from patentloom.catalog.tables import Tables
from patentloom.plans import fused, patents
from patentloom.sinks.files import written

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


def test_reports_equal_those_one_by_one(spark):
    t = Tables(spark, SF_DIR)
    info, cpc = written(t.patent_info, "info"), written(t.cpc_info, "cpc")
    alone = {
        "patents_by_decade": patents.by_decade(info),
        "common_patent_types": patents.common_types(info),
        "patent_trends": patents.by_year(info),
        "avg_grant_time_by_type": patents.avg_grant_time_by_type(info),
        "patent_type_claims": patents.claims_by_type(info),
        "filings_by_year": patents.filings_by_year(info),
        "long_grant_patents": patents.long_grants(info),
        "zero_claims": patents.zero_claims(info),
        "max_claims_year": patents.year_with_most_claims(info),
        "claims_year_type": patents.claims_by_year_and_type(info),
        "type_by_decade": patents.types_by_decade(info),
        "under_year": patents.granted_within(info),
        "claims_distribution": patents.claims_distribution(info),
        "avg_claims_filing": patents.avg_claims_by_filing_year(info),
        "grant_claim_corr": patents.grant_claim_correlation(info),
        "shortest_grant_cpc": patents.shortest_grant_sections(info, cpc),
        "avg_claims_cpc": patents.avg_claims_by_section(info, cpc),
        "median_grant_cpc": patents.median_grant_by_section(info, cpc),
        "trending_cpc": patents.sections_by_decade(info, cpc),
        "trending_cpc_top5": patents.rising_sections(info, cpc),
    }
    together = fused.reports(info, cpc)
    assert set(together) == set(alone)
    for name, df in alone.items():
        assert together[name].columns == df.columns, name
        assert [f.dataType for f in together[name].schema] == [f.dataType for f in df.schema], name
        assert rows_of(together[name]) == rows_of(df), name


def test_cells_are_one_scan_and_one_join(spark, tmp_path, plan_of):
    t = Tables(spark, SF_DIR)
    for name, df in {"p": t.patent_info, "c": t.cpc_info}.items():
        df.write.parquet(str(tmp_path / name))
    info, cpc = (spark.read.parquet(str(tmp_path / n)) for n in "pc")
    scans = lambda df: len(re.findall("Scan parquet", plan_of(df)))
    assert scans(fused.patent_cells(info)) == 1
    assert scans(fused.section_cells(info, cpc)) == 2
    # Whatever reads the stored cells reads nothing else.
    cells = fused.patent_cells(info)
    cells.write.parquet(str(tmp_path / "cells"))
    for df in fused.patent_reports(spark.read.parquet(str(tmp_path / "cells"))).values():
        assert scans(df) == 1 and "/cells" in plan_of(df)


def test_dates_may_be_missing(spark):
    schema = "patent_id string, patent_type string, patent_date date, filing_date date, num_claims int"
    rows = [("1", "u", None, None, 3), ("2", None, None, None, 0), ("3", "u", None, None, None)]
    info = spark.createDataFrame(rows, schema)
    got = fused.patent_reports(fused.patent_cells(info))
    assert rows_of(got["patents_by_decade"]) == [] and rows_of(got["filings_by_year"]) == []
    assert rows_of(got["zero_claims"]) == [(1,)]
    assert rows_of(got["patent_type_claims"]) == rows_of(patents.claims_by_type(info))
    assert rows_of(got["under_year"]) == [(None,)]
