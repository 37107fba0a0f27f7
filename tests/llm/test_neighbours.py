import numpy as np
import pytest
from pyspark.sql import functions as F

from envlake.llm import neighbours as nn


def brute(rows, k=5, every=50):
    """{query id: [(score, id)]}, best first, of all other valid ids of the same length."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept.setdefault(i, []).append(np.array(v, np.float64) / max(map(abs, v)))
    cos = lambda a, b: float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b))
    out = {}
    for q in kept:
        if q % every == 0:
            score = {}
            for a in kept[q]:
                for j, vs in kept.items():
                    for b in vs:
                        if j != q and len(a) == len(b):
                            score[j] = max(score.get(j, -2), round(cos(a, b), 12))
            out[q] = sorted((-s, j) for j, s in score.items())[:k]
    return out


def found(spark, rows, mass=0.96):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, label int, key string").repartition(5)
    out = {}
    for r in nn.nearest(df, F.col("vec_id") % 50 == 0, 5, mass).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({j for _, j in got.get(q, [])} & {j for _, j in own}) for q, own in want.items())
    return hits / sum(map(len, want.values()))


def small_parts(monkeypatch):
    for name, value in {"PART_ROWS": 60, "MOST_PARTS": 6, "SAMPLE": 400, "DATA_BLOCK": 50, "QUERY_BLOCK": 7, "ROUTE_BLOCK": 90, "STEPS": 150}.items():
        monkeypatch.setattr(nn, name, value)


@pytest.mark.parametrize("kind", ["clusters", "noise"])
def test_recall_over_several_levels(spark, monkeypatch, kind):
    small_parts(monkeypatch)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * (4 if kind == "clusters" else 0)
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(spark, rows), brute(rows)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.9
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert all(abs(s - unit[q] @ unit[j]) < 1e-12 for q, own in got.items() for s, j in own)


def test_structure_spares_most_parts(spark, monkeypatch):
    small_parts(monkeypatch)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16)) * 9
    x = centres[np.arange(3000) % 30] + rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    index = nn.Index(nn.written(nn.entries(df, 5), "entries"))
    rows = index.rows.groupBy("node").count().collect()
    assert sum(r["count"] for r in rows) == 3000 and len(index.levels) >= 2
    asked = df.where("vec_id % 50 = 0").select(nn.vector_key(F.col("embedding")).alias("key"), F.col("embedding").alias("v"))
    met = index.route(asked, 0.96, 6).join(index.rows.groupBy("node").agg(F.count("*").alias("n")), "node")
    assert met.agg(F.sum("n")).first()[0] < 0.35 * 60 * 3000


def test_hot_vector_copies_ties_and_bad_rows(spark, monkeypatch):
    small_parts(monkeypatch)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4)).round(1) + 0.05
    x[300:650] = x[0]  # a third of all rows, and queries among them
    x[700:820] = x[1] + rng.normal(size=(120, 4)) * 1e-6  # near copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5, x[5].tolist())] * 30 + [(50, x[9].tolist()), (100, (2 * x[100]).tolist())]
    rows += [(1000, None), (1050, [None] * 4), (1100, [float("nan")] + [0.5] * 3), (1150, [float("inf")] * 4), (None, x[0].tolist()), (1200, [0.0] * 4), (1250, [])]
    rows += [(2000, [1.0, 2.0]), (2001, [2.0, 1.0]), (2050, [3.0, -1.0]), (3000, [1.0]), (-50, [1e300, 1e-300, 1e300, 0.0])]
    got, want = found(spark, rows, mass=1.0), brute(rows)
    assert {q for q, own in want.items() if own} == set(got)
    for q, own in got.items():
        assert [j for _, j in own] == [j for _, j in want[q]] or np.allclose([s for s, _ in own], [-s for s, _ in want[q]], atol=1e-12)
        assert len(own) == len(want[q])
    assert [j for _, j in got[0]] == [300, 301, 302, 303, 304] and [j for _, j in got[300]][:2] == [0, 301]


def test_few_vectors_and_none(spark):
    assert found(spark, []) == {}
    assert found(spark, [(0, [1.0, 0.0])]) == {}
    assert found(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-2.0, 0.0])]) == {0: [(pytest.approx(0.5**0.5), 1), (-1.0, 2)]}


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(6)
    points = nn.unit(np.repeat(rng.normal(size=(8, 12)) * 5, 100, axis=0) + rng.normal(size=(800, 12)))
    graph = nn.neighbour_graph(points)
    part = nn.balanced_parts(graph, 8)
    assert np.bincount(part, minlength=8).max() <= 106
    assert (part[graph] != part[:, None]).mean() < 0.1
    model = nn.learn(points, 8)
    again = nn.Router.unpacked(model.pack())
    assert np.array_equal(model.probabilities(points), again.probabilities(points))
