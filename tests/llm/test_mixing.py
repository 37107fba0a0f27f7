import pytest

from envlake.llm.mixing import black_words, mix_sources, source_targets


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        if not rest:
            return {s: 2.0 * sizes[s] for s in order}
        level = (budget - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in rest)
        new = {s for s in rest if weight[s] * level >= 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= new


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, None: 7}, {"z": 5}, {"a": 0, "b": 3}, {f"s{i:02}": i * i for i in range(20)}])
def test_targets_reshare_what_is_above_the_cap(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = targets_by_hand(sizes)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_sources_take_their_targets_and_reruns_agree(spark):
    rows = [(i, ["a", "b", None, "é"][i % 4] if i % 3 else "hot", "w " * (i % 23)) for i in range(900)]
    rows += [(5, "b", "x y"), (5, "b", "x y"), (None, "a", "x"), (77, "a", None), (78, "a", "")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id bigint, source string, text string, range int, key string")
    results = []
    for size in (50_000, 7):
        found = mix_sources(df.repartition(3 + size % 5), black_words()).collect()
        results.append(sorted((str(r.doc_id), str(r.source), r.size, r.taken) for r in found))
    assert results[0] == results[1] and len(results[0]) == len(rows)
    by, target, total = {}, {}, {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source], target[r.source] = by.get(r.source, 0) + r.taken, r.target
        total[r.source] = total.get(r.source, 0) + r.size
    for s in by:
        assert by[s] == int(target[s])
        assert next(r.source_size for r in found if r.source == s) == total[s]


def test_no_rows_and_no_words(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert mix_sources(df, black_words()).count() == 0
    df = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id bigint, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mix_sources(df, black_words()).collect()] == [(0, 0.0, 0)] * 2


def test_copies_of_a_row_are_dealt_over_tasks_and_a_long_text_is_counted(spark):
    from envlake.operators import keys

    rows = [(7, "hot", "one two three")] * 2000 + [(100 + i, "hot", "w " * (i % 9)) for i in range(1500)] + [(9000, "b", "word " * 400_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = keys._placed(df.select("doc_id", "source"), ["doc_id"], ["source"])
        assert placed.where("doc_id = 7").groupBy("_task").count().agg({"count": "max"}).first()[0] < 1500
        found = mix_sources(df, black_words()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    copies = [r.taken for r in found if r.doc_id == 7]
    target = {r.source: r.target for r in found}
    assert len(copies) == 2000 and sum(x % 3 != 0 for x in copies) <= 1  # all whole but for the one at the cut
    assert sum(r.taken for r in found if r.source == "hot") == int(target["hot"])
    assert next(r for r in found if r.doc_id == 9000).size == 400_000
