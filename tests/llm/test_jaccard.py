import random

import numpy as np
import pytest

from envlake.llm.components import connected
from envlake.llm.jaccard import Answers, jaccard_components, local_components, signatures, size_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).split()
    return {tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def brute(rows):
    sets, least = {}, {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and 100 * len(x & y) >= 90 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    for i in ids:
        least[i] = find(i)
    return sorted([(i, len(shingles(t)), least.get(i)) for i, t in rows], key=str)


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        n = rng.choice([1, 2, 3, 5, 12, 30, 60, 200, 700])
        base = [f"w{rng.randint(0, 400)}" for _ in range(n)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, n // 60), max(1, n // 25)])):
                w[rng.randrange(len(w))] = f"v{rng.randint(0, 10**6)}"
            if rng.random() < 0.2:
                w.append("tail")
            rows.append((i, " ".join(w)))
            i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_brute_force(spark, seed):
    rows = near_copies(seed)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(rows)


def test_small_blocks_lose_no_link(spark, monkeypatch):
    from envlake.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    rows = near_copies(7, groups=4, copies=20)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(rows)


def test_nulls_empty_texts_repeated_rows_and_extra_columns(spark):
    long = " ".join(f"word{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "one"), (6, "a b c d"), (None, "a b c d"), (7, long), (8, long + " more"), (9, "a b c d")]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id bigint, text string, cluster int, node int")
    got = sorted([tuple(r) for r in jaccard_components(df).collect()], key=str)
    assert got == brute(rows)
    assert jaccard_components(df.limit(0)).count() == 0


def test_two_sets_that_link_share_a_list():
    rng = np.random.default_rng(3)
    for n in [1, 2, 5, 9, 10, 11, 19, 20, 40, 100, 333, 1000, 5000]:
        for _ in range(30):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            differ = len(x) * 10 // 190 * 2 if rng.random() < 0.5 else rng.integers(0, max(1, n // 9) + 1)
            drop = int(rng.integers(0, differ + 1)) if differ else 0
            y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, max(0, int(differ) - drop), dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 90 * (len(x) + len(y) - both) and len(y):
                assert set(signatures(x, 90).tolist()) & set(signatures(y, 90).tolist())


def test_groups_of_sizes_overlap_enough():
    for n in range(1, 3000):
        m = n * 100 // 90
        assert {g for g, _, _ in size_groups(n, 90)} & {g for g, _, _ in size_groups(m, 90)}


def test_local_components_by_derived_overlaps():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) > 0.02], rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)])) for _ in range(40)]
    want = list(range(40))
    for a in range(40):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    got = dict(local_components(list(range(40)), sets, 90))
    assert [got.get(i, i) for i in range(40)] == want
    got = dict(local_components(list(range(40)), sets, 90, [want[0] if w == want[0] else 100 + i for i, w in enumerate(want)]))
    assert [got.get(i, i) for i in range(40)] == want


def test_parities_lose_no_link():
    from envlake.llm.jaccard import may_link, parities

    rng = np.random.default_rng(9)
    for n in (1, 3, 10, 33, 64, 200, 1000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(n) > 0.06], rng.integers(0, 2**63, int(rng.integers(0, 2 + n // 8)), dtype=np.uint64)])) for _ in range(20)]
        sets = [s for s in sets if len(s)] + [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(5)]
        for percent in (80, 90):
            label = list(range(len(sets)))
            for i, j in may_link(np.array([len(s) for s in sets]), [np.frombuffer(parities(s), np.uint8) for s in sets], percent):
                label = [label[i] if x == label[j] else x for x in label]
            for i, x in enumerate(sets):
                for j, y in enumerate(sets):
                    both = len(np.intersect1d(x, y))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        assert label[i] == label[j]
            if n >= 64:
                assert len({label[i] for i in range(len(sets) - 5, len(sets))}) == 5  # unlike sets are told apart


def test_a_group_of_near_copies_is_compared_as_often_as_it_has_members(spark, monkeypatch):
    from envlake.llm import jaccard

    pairs, linked = [], jaccard._linked

    def counted(found, sets, percent):
        pairs.append(found.count())
        return linked(found, sets, percent)

    monkeypatch.setattr(jaccard, "_linked", counted)
    monkeypatch.setattr(jaccard, "_all_links", None)  # nothing is left for it
    for m in (100, 400):
        pairs.clear()
        rows = [(i, " ".join([*(f"w{j}" for j in range(300)), f"v{i}"])) for i in range(m)]
        found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert {r.component_id for r in found.collect()} == {0} and m - 1 <= sum(pairs) < 3 * m


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(50)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {5000: 5000}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _jobs_of(spark, act):
    """What act returns, and how many jobs it ran."""
    group = f"components-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = act()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_few_edges_cost_the_driver_no_rounds(spark, monkeypatch):
    """A chain needs many rounds of stars; where a task holds all edges, or some, components are the same."""
    edges = [(i, i + 1) for i in range(0, 60)] + [(x, 100) for x in range(101, 140)] + [(7, 7), (500, 500), (-3, 2), (None, 1)]
    want = {i: -3 for i in range(0, 61)} | dict.fromkeys(range(100, 140), 100) | {-3: -3, 500: 500}
    table = spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)
    find = lambda: {r.node: r.component for r in connected(table).collect()}
    got, jobs = _jobs_of(spark, find)
    assert got == want
    assert jobs <= 14
    monkeypatch.setattr("envlake.llm.components.EDGES_IN_A_FILE", 30)
    assert find() == want


def test_most_links_come_from_derived_answers_and_copies_cost_what_they_differ_in():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    cost = {}
    for m in (40, 160):
        seen = []

        class Watched(Answers):
            def __init__(self, sets):
                super().__init__(sets)
                seen.append(self)

        # each copy lacks a few shingles of the text and has a few of its own; two families, so that not all are one label
        sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 1000, 80 if i % 2 else 3)), rng.integers(0, 2**63, 3, dtype=np.uint64)])) for i in range(m)]
        assert local_components(list(range(m)), sets, 95, answers=Watched)
        assert seen[0].derived >= 5 * seen[0].counted
        cost[m] = seen[0].read / m
    # a whole answer reads 1000 lists of up to m places for each set; a derived one those of the shingles that differ
    assert cost[160] < 0.2 * 1000 * 160


def test_links_of_a_star_larger_than_a_block(spark, monkeypatch):
    from envlake.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 500)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(w if rng.random() > 0.004 else f"v{rng.randint(0, 9**9)}" for w in base)) for i in range(60)] + [(100 + i, f"other {i} text of its own") for i in range(5)]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(rows)
