import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from envlake.llm import audit

FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic). Every order is run over every document."""
    ids = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            ids.setdefault(text or "", []).append(doc_id)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, x in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), re.search("[#$%&*|]", text), doc_id is not None and any(i < doc_id for i in ids[text])), strict=True) if x}
        parts.setdefault(source or "", []).append((fails, doc_id in good, doc_id in toxic))
    rows, shapley = {}, {}
    for part, own in parts.items():
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                rest = [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in own)
                rows[part, "".join(order), step + 1] = [len(rest), len(gone), failing - len(gone), sum(d[0] == {f} for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                left = rest
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def run(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "m") for r in docs], "doc_id bigint, text string, source string, mask int, digest string").repartition(5)
    la = spark.createDataFrame([(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, part string")
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in FIELDS) for r in audit.audit(d, la).collect()}


def test_every_order_is_what_running_it_gives(spark):
    rng = random.Random(5)
    docs = []
    for i in range(160):
        n = rng.choice([0, 3, 199, 200, 260])
        kinds = rng.choice([2, 1000])
        text = " ".join(f"{'W' if rng.random() < 0.15 else 'w'}{rng.randrange(kinds)}" for _ in range(n)) + rng.choice(["", "", " #", " 5%", "\x0b é"])
        docs.append((i, text, rng.choice(["a", "b", "b", None, ""])))
    docs += [(1000 + i, docs[17][1], rng.choice("ab")) for i in range(90)]  # copies in two parts
    docs += [(17, docs[17][1], "b"), (None, docs[17][1], "a"), (None, docs[17][1], "a"), (None, None, None), (5000, None, "a"), (5001, "", "b"), (4999, "   ", "b"), (6000, "Very long " * 300_000, "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1100, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (99_999, 1, 1)]
    found = run(spark, docs, labels)
    assert found == brute(docs, labels)
    assert {k[0] for k in found} == {"a", "b", "c", ""} and len(found) == 4 * 600


def test_no_documents_and_no_labels(spark):
    assert run(spark, [], [(1, 1, 1)]) == {}
    docs = [(1, "one", "a")]
    assert run(spark, docs, []) == brute(docs, [])


def test_sums_invert_exactly(spark):
    rng = random.Random(9)
    masks = [rng.randrange(32) for _ in range(997)]
    rows = spark.createDataFrame([("p", m, m % 3 == 0, m % 5 == 0) for m in masks], "part string, mask int, good boolean, toxic boolean")
    sums = audit.parity_sums(rows, 5)
    assert sums.where("good and toxic").select(F.size("sums")).first()[0] == 32
    got = audit.cells(sums, 5).first()
    assert list(got.n) == [masks.count(m) for m in range(32)]
    assert list(got.good) == [masks.count(m) * (m % 3 == 0) for m in range(32)]
    assert list(got.toxic) == [masks.count(m) * (m % 5 == 0) for m in range(32)]
