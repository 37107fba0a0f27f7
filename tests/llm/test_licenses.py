import re

from envlake.llm.licenses import PHRASES, TEMPLATES, scan
from envlake.llm.text import ALNUM_WORD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIT, GPL = TEMPLATES[0][1], TEMPLATES[4][1]


def base(text):
    w = re.findall(ALNUM_WORD, (text or "").translate(LOWER))
    found = [(i, label) for label, phrase in PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


DOCS = [
    (1, "MIT-License and the Apache license, mit. license MIT LICENSE"),
    (2, "the gnu General Public\nLicense, general public licenses, General public license"),
    (3, None),
    (4, ""),
    (5, "word " * 9000 + "mit license " * 3 + "word " * 9000),
    (6, "See below. " + MIT),
    (7, "See below. " + MIT.replace("to deal in the Software", "to deal with this whole Software")),
    (8, " ".join(MIT.split()[:12])),
    (9, GPL.replace("published by", "issued by the") + " text"),
    (10, "licensed under cc by-nc 4.0."),
    (11, "mit"),
    (12, "license mit apache"),
    (2, "the gnu General Public\nLicense, general public licenses, General public license"),
]


def test_base_places_are_those_of_brute_force_and_templates_add_labels(spark):
    df = spark.createDataFrame([(*r, 0, 0) for r in DOCS], "doc_id bigint, text string, hash int, template int")
    rows = scan(df.repartition(3)).collect()
    assert len(rows) == len(DOCS)
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert got == sorted((i, *base(t)) for i, t in DOCS)
    labels = {r.doc_id: r.labels for r in rows}
    assert labels[6] == labels[7] == "mit" and labels[8] == "" and labels[9] == "gpl" and labels[10] == "cc-by-nc"
    for r in rows:
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_no_rows(spark):
    assert scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_driver_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan(docs).collect()}
    assert got == {(r.doc_id, *base(r.text)) for r in docs.collect()}


def test_many_templates_are_tables_and_are_not_sent_to_every_task(spark, monkeypatch):
    from envlake.llm import licenses

    words = [f"w{i}" for i in range(3000)]
    texts = [(f"l{i:04}", " ".join(words[(i * 7 + j * 13) % 3000] for j in range(30))) for i in range(10_000)]
    many = spark.createDataFrame(texts, "label string, text string")
    docs = spark.createDataFrame([(1, "before " + texts[77][1] + " after"), (2, " ".join(texts[4][1].split()[:10])), (3, None), (4, "mit license")], "doc_id bigint, text string")
    sent, real = [], licenses.F.broadcast
    monkeypatch.setattr(licenses, "MOST_SENT", 1 << 20)
    monkeypatch.setattr(licenses.F, "broadcast", lambda df: (sent.append(df), real(df))[1])
    got = {r.doc_id: (set(r.labels.split(",")), r.base_labels) for r in scan(docs, templates=many).collect()}
    assert not any("hash" in df.columns for df in sent)
    assert "l0077" in got[1][0] and got[2] == ({""}, "") and got[3] == ({""}, "") and got[4] == ({"mit"}, "mit")
    few = {r.doc_id: (set(r.labels.split(",")), r.base_labels) for r in scan(docs, templates=texts[:100]).collect()}
    assert any("hash" in df.columns for df in sent) and few == {**got, 1: few[1]} and "l0077" in few[1][0]
