"""Embedding near-dedup and connected components against brute force."""

import random

import numpy as np
import pytest

from patentloom.llm.components import connected_components
from patentloom.llm.embedding_dedup import Forest, _trees, leaves_of, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, vector int, tree string"


def components(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(200, 300)] + [(0, k) for k in range(400, 460)]
    links += [(rng.randrange(150), rng.randrange(150)) for _ in range(90)]
    nodes = {n for pair in links if pair[0] != pair[1] for n in pair}
    table = spark.createDataFrame([*links, (None, 1), (2, None)], "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in connected_components(table).collect()}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(700):
        if i % 3 and rows:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base + rng.standard_normal(16) * rng.choice([0, 0.02, 0.1, 0.3])
        else:
            v = rng.standard_normal(16)
        label = None if i % 50 == 49 else int(rng.integers(3))
        rows.append((i, [float(np.float32(x)) for x in v], label))
    return rows


def brute(rows, threshold=0.93):
    ok = [(i, np.array(v), lab) for i, v, lab in rows]
    links = {i: 0 for i, *_ in rows}
    pairs = []
    for x, (i, v, lab) in enumerate(ok):
        for j, w, other in ok[:x]:
            if lab is not None and lab == other:
                cos = v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))
                if cos >= threshold:
                    pairs.append((i, j))
                    links[i] += 1
                    links[j] += 1
    least = components(links, pairs)
    return {i: (links[i], least[i], i == least[i]) for i in links}


def test_one_leaf_is_exact(spark):
    rows = vectors(3)
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {r["vec_id"]: tuple(r)[1:] for r in near_duplicates(table).collect()}
    assert got == brute(rows)


def test_recall_with_many_leaves(spark):
    rows = vectors(4)
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    forest = Forest(leaf=30, block=16, least_sample=8)
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(table, forest=forest).collect()}
    want = {i: w[0] for i, w in brute(rows).items()}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.97 * sum(want.values())


def exact(unit, labels, threshold=0.93):
    near = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None])
    return near.sum(1) - 1


@pytest.mark.parametrize("piece", [16_384, 900])
def test_large_group_of_near_copies(spark, piece):
    """All links of 4,000 vectors that are near but not equal, beside others."""
    rng = np.random.default_rng(5)
    group = rng.standard_normal(64) + 0.2 * rng.standard_normal((4_000, 64))
    v = np.concatenate([group, rng.standard_normal((1_500, 64))]).astype(np.float32)
    labels = np.append(np.zeros(4_000, int), rng.integers(0, 2, 1_500))
    table = spark.createDataFrame(
        [(i, x.tolist(), int(lab), "x", 1, "y") for i, (x, lab) in enumerate(zip(v, labels, strict=True))],
        SCHEMA,
    )
    unit = v.astype(np.float64)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    want = exact(unit, labels)
    assert want[:4_000].min() > 3_000
    got = near_duplicates(table, forest=Forest(piece=piece)).orderBy("vec_id").collect()
    assert [r["n_links"] for r in got] == want.tolist()
    assert {r["component_id"] for r in got[:4_000]} == {0}


def recall(forest, n, common, seed=3):
    """Share of planted pairs at cosine 0.935 that share a leaf, among n vectors of one label
    whose mean cosine is ``common``."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    mean = unit(rng.standard_normal((1, 64)))
    v = np.sqrt(common) * mean + np.sqrt(1 - common) * unit(rng.standard_normal((n, 64)))
    v = unit(v)
    pairs = n // 20
    side = rng.standard_normal((pairs, 64))
    side = unit(side - (side * v[:pairs]).sum(1, keepdims=True) * v[:pairs])
    v[-pairs:] = 0.935 * v[:pairs] + np.sqrt(1 - 0.935**2) * side
    sample = v[rng.choice(n, min(n, forest.sample), replace=False)]
    trees = _trees(sample, np.zeros(len(sample), np.int64), n, 1, forest)
    met = np.zeros(pairs, bool)
    for tree in trees.trees:
        assert tree.splits
        for _, rows in leaves_of(v, tree, forest.seed):
            inside = np.zeros(n, bool)
            inside[rows] = True
            met |= inside[:pairs] & inside[-pairs:]
    return met.mean()


@pytest.mark.parametrize("common", [0.0, 0.8])
def test_recall_at_production_settings(common):
    found = recall(Forest(), 40_000, common)
    print(f"recall among 40,000 vectors of mean cosine {common}: {found:.4f}")
    assert found >= 0.985


def test_odd_rows(spark):
    one, nan, inf = [1.0, 0.0], float("nan"), float("inf")
    rows = [
        (1, one, 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0),
        (6, [1.0, None], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, one, None), (10, one, 1),
        (11, [1.0, 0.0, 0.0], 0), (None, one, 0), (2, [2.0, 0.0], 0), (12, one, 0),
    ]
    table = spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA)
    got = near_duplicates(table).collect()
    assert len(got) == len(rows)
    by_id = {r["vec_id"]: tuple(r)[1:] for r in got}
    assert by_id[1] == (2, 1, True) and by_id[12] == (2, 1, False) and by_id[2] == (2, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert by_id[i] == (0, i, True)
    assert by_id[None][:2] == (0, None)
    assert near_duplicates(table.limit(0)).collect() == []
