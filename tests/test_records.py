"""Nested feed records."""

import json

from patentloom.plans import records
from patentloom.sources.records import read_api_records


def api(doc, date, branch="AI", claims=((1, 2), (3,)), inventors=("Ann", None), applicants=("Org",)):
    def parties(names):
        return None if names is None else [
            {"extracted_name": {"value": n}} if n else {"extracted_name": {}} for n in names
        ]

    return {
        "doc_number": doc,
        "date_published": date,
        "branch": branch,
        "claims": None if claims is None else [
            {"claims": [str(c) for c in group]} for group in claims
        ],
        "biblio": {
            "parties": {"inventors": parties(inventors), "applicants": parties(applicants)}
        },
    }


def read(spark, tmp_path, *items):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(items, indent=2))
    return read_api_records(spark, str(path), multi_line=True)


def test_normalize(spark, tmp_path):
    raw = read(
        spark, tmp_path,
        api("1", "2024-10-31"),
        api("2", "2024-02-30"),
        api("3", "2023-12-31"),
        api("4", None),
        api("5", "2024-1-5", claims=None, inventors=None, applicants=()),
        api("6", "2024"),
    )
    got = {r.patent_id: r for r in records.normalize(raw, 2024).collect()}
    assert set(got) == {"1", "5"}
    assert got["1"].num_claims == 3 and got["1"].month == "2024_Oct"
    assert [tuple(i) for i in got["1"].inventors] == [("Ann", "U")]
    assert [tuple(a) for a in got["1"].applicants] == [("Org",)]
    assert (got["5"].num_claims, got["5"].inventors, got["5"].applicants) == (0, [], [])
    assert records.normalize(raw).count() == 3


def test_latest_per_branch_needs_all_parts(spark, tmp_path):
    raw = read(
        spark, tmp_path,
        api("1", "2024-10-01"), api("2", "2024-10-03"), api("3", "2024-10-02"),
        api("4", "2024-10-09", claims=None), api("5", "2024-10-09", inventors=()),
        api("6", "2024-10-02", branch="Net"), api("7", None),
    )
    got = records.latest_per_branch(raw, k=2).orderBy("branch", "rank").collect()
    assert [(r.branch, r.doc_number) for r in got] == [("AI", "2"), ("AI", "3"), ("Net", "6")]


def test_created_after_is_exclusive(spark, tmp_path):
    raw = read(spark, tmp_path, api("1", "2024-11-11"), api("2", "2024-11-12"), api("3", "bad"))
    assert [r.doc_number for r in records.created_after(raw, "2024-11-11").collect()] == ["2"]
