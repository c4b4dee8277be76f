"""Line dedup against brute force."""

import random

import pytest

from patentloom.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, row int, no string, n_lines string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows, edits, least):
    lines, out = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None:
            out[doc] = (None, 0, 0)
            continue
        own = text.split("\n")
        kept = []
        for line in own:
            if not line.strip(" "):
                kept.append(line)
                continue
            if not any(
                line == x
                or (min(len(line), len(x)) >= least and abs(len(line) - len(x)) <= edits
                    and distance(line, x) <= edits)
                for x in lines
            ):
                kept.append(line)
            lines.append(line)
        out[doc] = ("\n".join(kept), len(own), len(own) - len(kept))
    return out


def corpus(seed, edits):
    rng = random.Random(seed)
    letters = "abcé日 "

    def fresh(n):
        return "".join(rng.choice(letters) for _ in range(n))

    pool = [fresh(rng.randrange(1, 30)) for _ in range(12)] + ["", "  ", "x"]
    for _ in range(90):
        line = list(rng.choice(pool[:40]))
        for _ in range(rng.randrange(edits + 2)):
            at = rng.randrange(len(line) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                line.insert(at, rng.choice(letters))
            elif at < len(line):
                line[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
        pool.append("".join(line))
    rows = [(i, "\n".join(rng.sample(pool, rng.randrange(1, 6)))) for i in range(40)]
    rng.shuffle(rows)
    return [*rows, (90, None), (91, ""), (92, "\n\n"), (None, rng.choice(pool) + "\nlast one")]


@pytest.mark.parametrize("edits, crowd", [(1, 32), (1, 0), (1, 2), (2, 32)])
def test_matches_brute_force(spark, edits, crowd):
    rows = corpus(edits * 10 + crowd, edits)
    docs = spark.createDataFrame([(*r, 7, "a", "b") for r in rows], SCHEMA)
    out = dedup_lines(docs, edits=edits, least_chars=6, crowd=crowd)
    assert out.columns == ["doc_id", "text", "row", "no", "n_lines", "n_removed"]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()}
    assert got == brute(rows, edits, 6)


def test_equal_rows_and_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a\nb\na", 1, "", ""), (1, "a\nb\na", 2, "", ""), (2, "b\nc", 3, "", "")]
    got = dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["row"], r["text"]) for r in got) == [(1, "a\nb"), (2, "a\nb"), (3, "c")]


def test_runs_without_python(spark, plan_of):
    plan = plan_of(dedup_lines(spark.createDataFrame([(1, "a", 1, "", "")], SCHEMA)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
