import re
from collections import Counter
from math import log

import numpy as np
import pytest

from envlake.llm import lm
from envlake.llm.text import ALNUM_WORD

DOCS = [(1, "good water good"), (2, "bad air"), (3, None), (4, ""), (5, "good water good"), (6, "Good rare1 bad"), (None, "bad air bad"), (8, "x " * 20000)]
GOOD = [(1,), (5,), (5,), (99,)]


def brute(vocabulary):
    """The same models with dictionaries."""
    code = {w: i + 1 for i, w in enumerate(vocabulary)}
    models = []
    seqs = {}
    for n, (i, t) in enumerate(DOCS):
        seqs[n] = (i, [code.get(w.lower(), 0) for w in re.findall(ALNUM_WORD, (t or "").lower())])
    start = len(vocabulary) + 1
    for chosen in ({1, 5}, None):
        pairs, ones = Counter(), Counter()
        for i, s in seqs.values():
            if s and (chosen is None or i in chosen):
                ones.update(s)
                ones[start] += 1
                for a, b in zip([start, *s], s, strict=False):
                    pairs[int(lm.counter(np.array([a]), np.array([b]))[0])] += 1
        models.append((pairs, ones))
    out = {}
    for n, (_, s) in seqs.items():
        losses = []
        for pairs, ones in models:
            total = sum(ones.values()) - ones[start]
            loss = 0.0
            for a, b in zip([start, *s], s, strict=False):
                alone = (ones[b] + 1) / (total + len(vocabulary) + 1)
                p = (pairs[int(lm.counter(np.array([a]), np.array([b]))[0])] + lm.WEIGHT * alone) / (ones[a] + lm.WEIGHT)
                loss -= log(min(p, 1))
            losses.append(loss / len(s) if s else None)
        out[n] = (len(s), *losses)
    return out


def test_scores_are_those_of_brute_force(spark):
    df = spark.createDataFrame([(*r, False) for r in DOCS], "doc_id bigint, text string, target boolean")
    good = spark.createDataFrame(GOOD, "doc_id bigint")
    vocabulary = lm.frequent_words(df.select("text"), 4)
    assert vocabulary == ["bad", "good", "x"] or len(vocabulary) <= 4
    got = sorted((r for r in lm.cross_entropy_difference(df, good, words=4).collect()), key=lambda r: (str(r.doc_id), r.n_tokens))
    want = sorted(((d[0], *v) for d, v in zip(DOCS, brute(vocabulary).values(), strict=True)), key=lambda r: (str(r[0]), r[1]))
    for r, (doc_id, n, target, background) in zip(got, want, strict=True):
        assert (r.doc_id, r.n_tokens) == (doc_id, n)
        if n:
            assert r.loss_target == pytest.approx(target) and r.loss_background == pytest.approx(background)
            assert r.score == pytest.approx(target - background)
        else:
            assert r.loss_target is r.loss_background is r.score is None
    by = {r.doc_id: r.score for r in got}
    assert by[1] < by[2]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    ids = df.select("doc_id")
    assert lm.cross_entropy_difference(df, ids).count() == 0
    assert lm.cross_entropy_difference(some, ids).first().n_tokens == 2


def test_frequent_words_are_bounded(spark):
    rows = [(" ".join(f"w{i}" for i in range(n)),) for n in (1, 2, 4, 8, 16, 32)]
    df = spark.createDataFrame(rows, "text string")
    for most in (0, 1, 3, 5, 100):
        found = lm.frequent_words(df, most)
        assert len(found) <= most and found == sorted(found)
    assert len(lm.frequent_words(df, 100)) == 32


def test_every_word_and_bigram_has_its_own_count(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET", 20000)
    monkeypatch.setattr(lm, "PIECE", 1 << 14)
    rng = np.random.default_rng(3)
    seqs = [[f"v{x}" for x in np.where(rng.random(400) < 0.2, 0, rng.integers(0, 40000, 400))] for _ in range(1000)]
    seqs += [["a", "b"], ["a", "b"], ["b"], []]
    good = set(range(0, 1000, 7)) | {1000}
    n = [[Counter(), Counter()] for _ in range(2)]
    for i, s in enumerate(seqs):
        for m in (0, 1) if i in good else (1,):
            n[m][0].update(s)
            n[m][0].update([""] if s else [])
            n[m][1].update(zip(["", *s], s, strict=False))
    assert len(n[1][1]) > 1 << 18 and len(n[1][0]) > 1 << 15  # more than a table of 2^18 counters and 2^15 words
    df = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(seqs)], "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in lm.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in good], "doc_id bigint")).collect()}
    assert len(got) == len(seqs) and got[1003].n_tokens == 0 and got[1003].score is None
    distinct = len(n[1][0]) - 1
    for i, s in enumerate(seqs[:-1]):
        want = []
        for ones, pairs in n:
            total = sum(ones.values()) - ones[""]
            want.append(-sum(log((pairs[a, b] + lm.WEIGHT * (ones[b] + 1) / (total + distinct + 1)) / (ones[a] + lm.WEIGHT)) for a, b in zip(["", *s], s, strict=False)) / len(s))
        assert got[i].n_tokens == len(s)
        assert (got[i].loss_target, got[i].loss_background) == pytest.approx(tuple(want))


def test_the_filter_keeps_every_target_and_few_others(spark):
    rows = spark.range(-20_000, 20_000).selectExpr("if(id = 77, null, id) as doc_id", "'x' as text")
    ids = spark.range(0, 20_000, 3).selectExpr("id as doc_id")
    got = {r.doc_id for r in lm.likely_rows(rows, ids).collect()}
    assert set(range(0, 20_000, 3)) <= got and len(got) < 7200
    assert lm.likely_rows(rows, ids.limit(0)).count() == 0


def test_equally_frequent_words_fill_the_vocabulary(spark):
    df = spark.createDataFrame([(" ".join(f"w{i:02}" for i in range(50)),)] * 3 + [("w49",)], "text string").repartition(4)
    found = lm.frequent_words(df, 40)
    assert len(set(found)) == 40 and "w49" in found and found == sorted(found) == lm.frequent_words(df.repartition(2), 40)
    more = spark.createDataFrame([(" ".join(f"a{i} " * (1 + i // 10) for i in range(1000)),)], "text string")
    for most in (5, 95, 100, 333, 1000, 2000):
        found = lm.frequent_words(more, most)
        counts = sorted((1 + int(w[1:]) // 10 for w in found), reverse=True)
        assert counts == sorted((1 + i // 10 for i in range(1000)), reverse=True)[:most]
