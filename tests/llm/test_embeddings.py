"""Embedding near-dedup and nearest neighbours against brute force in double precision."""

import math

import numpy as np
import pytest

from sheafline.llm import ann, embedding_dedup
from sheafline.llm.vectors import kmeans, unit

SCHEMA = "vec_id long, embedding array<float>, label string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def planted(seed, n, dimension=16):
    """Clusters, chains at the threshold, exact copies, scaled copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dimension))
    rows = [centres[rng.integers(6)] + rng.normal(size=dimension) * rng.choice([0.05, 0.3, 1.0]) for _ in range(n)]
    for i in rng.integers(0, n, n // 3):
        rows.append(rows[i] * rng.choice([1.0, 2.0]) + rng.normal(size=dimension) * rng.choice([0.0, 0.01, 0.1]))
    rows += [rows[0]] * (n // 2)
    return [np.asarray(r, np.float32) for r in rows]


BAD = [None, [], [0.0] * 16, [math.nan] * 16, [1.0] * 15 + [math.inf], [1.0] * 15 + [None], [1.0, 2.0]]


def brute(vectors, threshold):
    x = unit(np.array(vectors, np.float64))
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[i], *label[near[i]]) if near[i].any() else label[i] for i in range(len(x))])
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize("block_rows", [20, 10_000])
def test_near_duplicates(spark, block_rows):
    vectors = planted(1, 150)
    ids = [3 * i + 1 for i in range(len(vectors))]
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, vectors)] + [(10_000 + k, v) for k, v in enumerate(BAD)] + [(None, [1.0] * 16)]
    got = embedding_dedup.near_duplicates(table(spark, rows), block_rows=block_rows).collect()
    assert len(got) == len(rows)
    links, label = brute(vectors, 0.95)
    told = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    for i, n, c in zip(ids, links, label):
        assert told[i] == (n, ids[c], ids[c] == i)
    assert all(told[10_000 + k] == (0, 10_000 + k, True) for k in range(len(BAD))) and told[None] == (0, None, True)


def test_repeated_rows_and_empty_tables(spark):
    got = embedding_dedup.near_duplicates(table(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert embedding_dedup.near_duplicates(table(spark, [])).count() == 0
    assert embedding_dedup.near_duplicates(table(spark, [(4, None)])).collect()[0]["component_id"] == 4


def test_one_id_with_usable_and_unusable_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, None), (2, [0.0, 1.0]), (3, None), (3, [0.0, float("nan")]), (5, [1.0, 0.1]), (5, [1.0, 0.1, 0.0])]
    got = embedding_dedup.near_duplicates(table(spark, rows)).collect()
    told = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got)
    assert told == [(1, 0, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True), (3, 0, 3, True), (5, 0, 5, True), (5, 1, 1, False)]


def test_no_pair_meets_twice_or_never(spark):
    """Vectors spread evenly, so that every cell borders on every other."""
    rng = np.random.default_rng(7)
    vectors = [v for v in rng.normal(size=(400, 3))]
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(vectors)]
    got = embedding_dedup.near_duplicates(table(spark, rows), block_rows=25).collect()
    links, _ = brute(np.float32(vectors), 0.95)
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(links))


def nearest(vectors, ids, query, k):
    far = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != ids[query]][:k]
    return [(ids[i], far[i]) for i in order]


def test_search_recall_and_scores(spark):
    vectors = np.array(planted(2, 900), np.float64)
    ids = np.arange(len(vectors)) * 5
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids, vectors)] + [(100_000 + 100 * k, v) for k, v in enumerate(BAD)] + [(None, [1.0] * 16)]
    got = ann.search(table(spark, rows)).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = [q for q in range(len(ids)) if ids[q] % 100 == 0]
    assert set(by) == {int(ids[q]) for q in queries}
    hits = 0
    for q in queries:
        found = by[int(ids[q])]
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - math.sqrt(((vectors[i // 5] - vectors[q]) ** 2).sum())) < 1e-9 for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {int(i) for i, _ in nearest(vectors, ids, q, 10)})
    assert hits / (10 * len(queries)) >= 0.9


def test_ties_and_few_rows(spark):
    same = [(i, [1.0, 1.0]) for i in range(0, 300, 10)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(table(spark, [*same, (0, [1.0, 1.0])])).collect()]
    for q in (0, 100, 200):
        assert sorted((rank, i) for query, rank, i, _ in got if query == q) == [(n, i) for n, i in enumerate([i for i in range(0, 300, 10) if i != q][:10], 1)]
    few = sorted((r["rank"], r["vec_id"], r["score"]) for r in ann.search(table(spark, [(100, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0])])).collect())
    assert few == [(1, 1, 1.0), (2, 2, 3.0)]
    assert ann.search(table(spark, [])).count() == 0 and ann.search(table(spark, [(1, [1.0])])).count() == 0
    assert ann.search(table(spark, [(100, [1.0])])).count() == 0
    twice = ann.search(table(spark, [(100, [0.0, 1.0]), (100, [9.0, 1.0]), (1, [0.0, 2.0]), (2, [9.0, 3.0])])).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in twice) == [(100, 1, 1), (100, 1, 2), (100, 2, 1), (100, 2, 2)]


def test_best_bin_first_lists_all_leaves():
    rows = np.random.default_rng(5).normal(size=(500, 4))
    tree = ann.Tree(rows, leaf_rows=20)
    listed = list(tree.leaves(rows[0]))
    assert sorted(listed) == sorted(tree.members) and sum(len(m) for m in tree.members.values()) == 500
    assert set(tree.file(rows)) <= set(tree.members)
    assert 0 < ann.calibrate(tree, rows, 10, 0.9) <= ann.calibrate(tree, rows, 10, 0.99) <= 1 and ann.calibrate(tree, rows[:1], 10, 0.9) == 1


def test_kmeans():
    rows = np.vstack([np.random.default_rng(1).normal(c, 0.01, (50, 2)) for c in ((0, 5), (5, 0))])
    assert sorted(np.round(kmeans(rows, 2, spherical=False)).tolist()) == [[0.0, 5.0], [5.0, 0.0]]
    assert len(kmeans(np.ones((9, 2)), 4, spherical=False)) == 1
