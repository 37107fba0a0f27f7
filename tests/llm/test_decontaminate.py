import hashlib
import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from envlake.llm.decontaminate import ALNUM_WORD, build_index, decontaminate, term_counts, test_windows
from envlake.llm.store import small_batches, written

test_windows.__test__ = False
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, n=10):
    words = lambda t: re.findall(ALNUM_WORD, (t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - n + 1, 1)) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[k]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return sorted(out, key=str)


PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away from here"
DOCS = [
    (1, f"Before {PASSAGE.upper()}! after"),
    (2, "the quick brown fox jumps over the lazy cat and runs far away from here"),
    (3, None),
    (4, ""),
    (5, "hello world hello world"),
    (5, "hello world hello world"),
    (None, PASSAGE),
    (7, ("x " * 5000) + PASSAGE + (" the quick brown" * 3000)),
    (8, "the quick brown fox jumps over the lazy dog and the quick brown fox jumps over the lazy dog and"),
]
ITEMS = [(10, PASSAGE), (9, "Hello, World"), (11, None), (12, "?!"), (13, "and runs far away from here"), (10, PASSAGE), (None, "lazy cat")]


def result(found):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in found.collect()], key=str)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*r, "x", 0) for r in DOCS], "doc_id bigint, text string, shard string, row int")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_hits_are_those_of_brute_force(tables):
    assert result(decontaminate(*tables)) == brute(DOCS, ITEMS)


def test_several_blocks_give_the_same(tables, monkeypatch):
    from envlake.llm import decontaminate as module

    monkeypatch.setattr(module, "BLOCK", 3)
    assert result(decontaminate(*tables)) == brute(DOCS, ITEMS)


def test_windows_of_two_words_over_all_driver_rows(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert result(decontaminate(docs, items)) == want


def test_proximity_finds_words_out_of_place(spark):
    docs = spark.createDataFrame([(1, "one two extra three four")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    assert not decontaminate(docs, items).first().contaminated
    near = decontaminate(docs, items, slop=1).first()
    assert near.contaminated and near.n_hit == 5


def test_proximity_stays_in_a_document_and_keeps_exact_matches(spark):
    docs = spark.createDataFrame([(1, "z z a"), (2, "b a"), (3, "b"), (4, "a z z b b a")], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([(1, "b a")], "item_id bigint, text string")
    for slop in range(4):
        hit = {r.doc_id: r.n_hit for r in decontaminate(docs, items, slop=slop).collect()}
        assert hit[2] == 2 and hit[1] == hit[3] == 0 and hit[4] >= 2


def test_proximity_is_that_of_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    items = [(i, " ".join(rng.sample("abcde", 3))) for i in range(8)]
    docs, tests = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    counts = Counter(w for _, t in rows for w in t.split())
    for slop in (0, 1, 2):
        want = {}
        for i, t in rows:
            w = t.split()
            for item, text in items:
                q = text.split()
                at = min(range(3), key=lambda j: (counts[q[j]], j))
                if any(w[p] == q[at] and all(any(w[x] == q[j] for x in range(max(0, p + j - at - slop), min(len(w), p + j - at + slop + 1))) for j in range(3)) for p in range(len(w))):
                    want.setdefault(i, set()).add(str(item))
        got = {r.doc_id: set(r["items"]) for r in decontaminate(docs, tests, slop=slop).collect() if r.contaminated}
        assert got == want


def test_empty_tables(spark, tables):
    docs, items = tables
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_postings_count_every_word(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "doc_id bigint, text string")
    assert {bytes(r.term): r.n for r in term_counts(build_index(docs)).collect()} == {b"a": 2, b"b": 2}


def test_readers_and_writers_of_the_index_hold_one_shard(spark, monkeypatch):
    from envlake.llm import decontaminate as module

    groups = {}

    def counted(df, name, **options):
        out = written(df, name, **options)
        groups[name] = [(m.num_rows, m.num_row_groups) for m in (pq.read_metadata(f.removeprefix("file:")) for f in out.inputFiles())]
        return out

    monkeypatch.setattr(module, "written", counted)
    docs = spark.createDataFrame([(i, f"{i} " * 1_200_000) for i in range(4)], "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: r.n_hit for r in decontaminate(docs, spark.createDataFrame([(1, "2 2")], "item_id bigint, text string")).collect()}
    assert found == {0: 0, 1: 0, 2: 1_200_000, 3: 0}
    assert sum(rows for rows, _ in groups["postings"]) == 4 and all(rows == n for rows, n in groups["postings"])


def test_batches_for_python_are_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        small_batches(spark)
        docs = spark.range(40).coalesce(1).selectExpr("repeat('x', 1000000) AS text")
        sizes = [r.n for r in docs.mapInArrow(lambda batches: (b.slice(0, 0).from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint").collect()]
        assert len(sizes) >= 8 and max(sizes) < 8_000_000
        spark.conf.set(key, "9999999")
        small_batches(spark)
        assert spark.conf.get(key) == "9999999"
    finally:
        spark.conf.set(key, before)
