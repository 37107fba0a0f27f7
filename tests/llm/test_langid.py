import numpy as np
from pyspark.sql import functions as F

from envlake.llm import langid

WORDS = {"en": "the and of ing tion that with from house water", "de": "der und die ung schaft mit nicht haus über größe", "fr": "le et les tion que avec où été maison élève"}


def corpus(n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split(), int(rng.integers(1, 40)))).upper() if i % 7 == 0 else " ".join(rng.choice(WORDS[lang].split(), 30)) + " 42 !!", lang, "s"))
    return rows


def test_held_out_accuracy_and_defined_results(spark):
    odd = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 ... !!", None, "s"), (1003, "漢字", "en", "s"), (1004, "the " * 50000, None, "s"), (None, "und die ung", "de", "s")]
    df = spark.createDataFrame([(*r, "z", 1.0) for r in corpus() + odd], "doc_id bigint, text string, lang string, source string, lang_pred string, score double")
    found = {r.doc_id: r for r in langid.predict(df, langid.train(df, ~langid.held_out())).withColumn("held", langid.held_out()).collect()}
    held = [r for r in found.values() if r.held and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 80 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and found[1000].score == 0
    assert found[1004].lang_pred == "en"


def test_no_rows_and_no_labels(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = langid.train(df, F.lit(True))
    assert langid.predict(df, model).count() == 0
    some = spark.createDataFrame([(1, "words", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in langid.predict(some, langid.train(some, F.lit(True))).collect()] == ["und"]


def test_prediction_sees_the_text_alone(spark):
    df = spark.createDataFrame(corpus(90), "doc_id bigint, text string, lang string, source string")
    model = langid.train(df, F.lit(True))
    a = [r.lang_pred for r in langid.predict(df, model).orderBy("doc_id").collect()]
    blind = df.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert a == [r.lang_pred for r in langid.predict(blind, model).orderBy("doc_id").collect()]


def test_held_out_ids_are_those_of_crc32(spark):
    import zlib

    got = {r.id: r.h for r in spark.range(200).select("id", langid.held_out("id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)}


def test_regularisation_leaves_weights_at_zero_and_temperature_calibrates(spark):
    rows = []
    labels = ["de", "en", "fr"]
    for _, text, lang, _ in corpus(300):
        rows.append((labels.index(lang), *langid.features(text)))
    model = langid.fit(labels, np.ones(1 << langid.BITS), rows)
    assert 0 < (model.weights != 0).mean() < 0.2
    assert model.temperature > 0


def test_many_languages_with_more_features(spark):
    rng = np.random.default_rng(12)
    scripts = [range(0x61, 0x7B), range(0x3B1, 0x3CA), range(0x430, 0x450), range(0x5D0, 0x5EB), range(0x10D0, 0x10F1), range(0x905, 0x93A)]
    rows = []
    for lang in range(48):
        letters = [chr(c) for c in scripts[lang % len(scripts)]]
        words = ["".join(rng.choice(letters, int(rng.integers(2, 9)))) for _ in range(60)]
        rows += [(lang * 60 + i, " ".join(rng.choice(words, int(rng.integers(8, 30)))), f"l{lang:02}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(df, ~langid.held_out(), bits=18)
    assert len(model.labels) == 48 and model.bits == 18 and model.weights.shape == (1 << 18, 48)
    held = langid.predict(df.where(langid.held_out()), model).collect()
    assert len(held) > 700 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
