import numpy as np
import pytest
from pyspark.sql import functions as F

from envlake.llm.topk import Tree, dual_search, quantised, search


def brute(rows, k=5, every=50):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept[i] = np.floor(256 * np.array(v, np.float64)).astype(np.int64)
    out = []
    for i in kept:
        if i % every == 0:
            best = sorted((-int(kept[i] @ kept[j]), j) for j in kept if j != i and len(kept[j]) == len(kept[i]))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def rows_of(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) / 4
    x[n // 2 : n // 2 + n // 3] = x[0]  # a hot vector: ties by the thousand
    return [(i, [float(v) for v in np.float32(x[i])]) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_top_five_are_those_of_brute_force(spark, seed, monkeypatch):
    from envlake.llm import topk

    monkeypatch.setattr(topk, "DATA_BLOCK", 150)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "LEAF", 8)
    rows = rows_of(700, 6, seed) + [(1000, None), (1050, [None] * 6), (1100, [float("nan")] + [0.0] * 5), (1150, [float("inf")] * 6), (None, [0.0] * 6), (1200, [1.0, 2.0]), (1250, [3.0, 1.0]), (1300, []), (-50, [0.5] * 6), (-50, [0.5] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, d int")
    found = search(quantised(df), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_blocks_far_away_are_not_compared(spark, monkeypatch):
    from envlake.llm import topk

    monkeypatch.setattr(topk, "DATA_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 4
    rows = [(i, [float(v) for v in centres[i % 8] + rng.normal(size=16) / 50]) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = search(quantised(df), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute([(i, np.float64(v).tolist()) for i, v in rows])


def test_fewer_vectors_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id bigint, embedding array<float>")
    assert sorted(tuple(r) for r in search(quantised(df), F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    assert search(quantised(df.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_tree_covers_its_points():
    points = np.random.default_rng(2).normal(size=(900, 5))
    tree = Tree(points)
    assert sorted(tree.order.tolist()) == list(range(900))
    laid = points[tree.order]
    for node in range(len(tree.radius)):
        own = laid[tree.first[node] : tree.last[node]]
        assert len(own) and np.sqrt(((own - tree.centre[node]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-9
        centres = tree.centre[tree.children[node]] if tree.children[node] else []
        for i in range(len(centres)):
            for j in range(i):
                assert np.sqrt(((centres[i] - centres[j]) ** 2).sum()) > tree.radius[node] * 0.7 - 1e-9


def test_large_components_stay_exact():
    ids = np.array([1, 2, 3])
    for n, most in ((2**30, 2**60 + 3), (2**40, 2**63 - 1)):
        x = np.array([[n, 1], [n, 2], [n, 3]], np.int64)
        assert [v.tolist() for v in dual_search(ids[:1], x[:1], ids, x, 1)] == [[1], [3], [most]]


def test_copies_of_a_best_match_take_one_place(spark):
    rows = [(0, [1.0, 0.0]), *[(1, [4.0, 0.0])] * 5, *[(i, [4.0 - i / 4, 1.0]) for i in range(2, 8)]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in search(quantised(df), F.col("vec_id") % 50 == 0).collect()) == brute(rows)


def test_an_id_with_several_vectors_has_its_best_score(spark, monkeypatch):
    from envlake.llm import topk

    monkeypatch.setattr(topk, "DATA_BLOCK", 20)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(8)
    rows = [(i % 70, [float(x) for x in rng.normal(size=4) * (3 if i % 70 < 4 else 1)]) for i in range(420)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    own: dict = {}
    for i, v in rows:
        own.setdefault(i, []).append(np.floor(256 * np.array(v)).astype(np.int64))
    want = []
    for i in (0, 50):
        best = sorted((-max(int(x @ y) for x in own[i] for y in own[j]), j) for j in own if j != i)[:5]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(tuple(r) for r in search(quantised(df), F.col("vec_id") % 50 == 0).collect()) == want


def test_each_level_leaves_fewer_pairs(spark, monkeypatch):
    from envlake.llm import topk

    for name, value in {"DATA_BLOCK": 30, "QUERY_BLOCK": 2, "MOST_CELLS": 5, "ROUTE_BLOCK": 100, "LEAF": 8}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(6)
    outer = rng.normal(size=(6, 12)) * 6
    inner = rng.normal(size=(30, 12))
    rows = [(i, [float(v) for v in outer[i % 6] + inner[i % 30] + rng.normal(size=12) / 30]) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(700)]  # a hot vector
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    left = []
    found = search(quantised(df), F.col("vec_id") % 50 == 0, report=lambda level, pairs: left.append(pairs))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)
    # equal vectors are few from the start, and every level of the tree leaves less to compare
    assert len(left) >= 3 and left[0] <= 44 * 1510 and all(b <= a for a, b in zip(left, left[1:], strict=False)) and left[-1] < 0.3 * left[0]


def test_ids_with_several_vectors_over_levels(spark, monkeypatch):
    from envlake.llm import topk

    for name, value in {"DATA_BLOCK": 20, "QUERY_BLOCK": 2, "MOST_CELLS": 3, "LEAF": 8}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 5))
    rows = [(i % 100 + (0 if i % 3 else 1000), [float(v) for v in x[i]]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in search(quantised(df), F.col("vec_id") % 50 == 0).collect())
    q = {}
    for i, v in rows:
        q.setdefault(i, []).append(np.floor(256 * np.array(v)).astype(np.int64))
    want = []
    for i in q:
        if i % 50 == 0:
            best = sorted((-max(int(a @ b) for a in q[i] for b in q[j]), j) for j in q if j != i)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)


def test_points_without_clusters_are_one_leaf():
    rng = np.random.default_rng(3)
    assert Tree(rng.normal(size=(1000, 64))).children == [[]]
    centres = rng.normal(size=(4, 64)) * 9
    assert len(Tree(centres[np.arange(1000) % 4] + rng.normal(size=(1000, 64)) / 50).children[0]) == 4


@pytest.mark.parametrize("large", [1, 2**28])
def test_scores_below_those_that_queries_have_reached_are_left_out(large):
    rng = np.random.default_rng(5)
    x, ids = rng.integers(-3, 4, size=(400, 4)) * large, np.arange(400) % 250  # ties, and ids with two vectors
    q, k = x[:9], 4
    whole = [*zip(*(v.tolist() for v in dual_search(np.arange(9), q, ids, x, k, others=False)), strict=True)]
    reached = {i: min(s for j, _, s in whole if j == i) for i in range(9)}
    least = np.array([-np.inf if i == 0 else reached[i] + (i % 2) for i in range(9)], object)
    found = [*zip(*(v.tolist() for v in dual_search(np.arange(9), q, ids, x, k, others=False, least=least)), strict=True)]
    assert sorted(found) == sorted(r for r in whole if r[2] >= least[r[0]])


def test_leaves_come_with_data_blocks_and_roots_hold_their_rows(spark, monkeypatch):
    from envlake.llm import topk

    monkeypatch.setattr(topk, "DATA_BLOCK", 20)
    q = [[i % 7 - 3, i, -i] for i in range(90)] + [[], [0, 0]]
    df = spark.createDataFrame([(str(i), i, v, i % 30 == 0) for i, v in enumerate(q)], topk.VECTOR)
    cells = topk.Cells(df)
    roots = {r.node: r for r in cells.levels[0].collect()}
    assert {n: (r.centre, r.n) for n, r in roots.items()} == {"d0": ([], 1), "d2": ([0.0, 0.0], 1), "d3": ([0.0] * 3, 90)}
    lengths = [np.sqrt(sum(x * x for x in v)) for v in q]
    assert roots["d0"].s == roots["d2"].s == 0 and roots["d3"].s >= max(lengths) - 1e-9 and abs(roots["d3"].r - max(lengths[:90:30])) < 1e-9
    rows = cells.rows.collect()
    assert sorted(r.key for r in rows) == sorted(str(i) for i in range(len(q)))
    assert all(r.d.rpartition("#")[0] == r.node for r in rows) and max(sum(r.d == d for r in rows) for d in {r.d for r in rows}) <= 2 * 20
