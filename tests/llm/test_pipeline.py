import re
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from envlake.llm import decontaminate, jaccard


def test_stages_keep_columns_and_clean_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").cache()
    first = corpus_pipeline.language_id(spark, docs, data)
    assert first.columns == docs.columns
    assert first.count() >= docs.where("text rlike '[a-z]{3}'").count() * 0.98

    kept = corpus_pipeline.near_duplicates(spark, docs, data)
    groups = Counter(r.component_id for r in jaccard.jaccard_components(docs, 5, 80).collect())
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(groups)

    clean = corpus_pipeline.benchmark_decontamination(spark, docs, data)
    hit = {r.doc_id for r in decontaminate.decontaminate(docs, spark.read.parquet(f"{data}/benchmark.parquet")).where("contaminated").collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - hit

    redacted = corpus_pipeline.secret_scan(spark, docs, data)
    assert redacted.columns == docs.columns and redacted.count() == docs.count()
    assert redacted.where("text rlike 'AKIA[0-9A-Z]{16}' or text rlike 'token = \"[0-9a-f]{40}'").count() == 0
    both = redacted.join(docs.select("doc_id", F.col("text").alias("was")), "doc_id")
    assert both.where("text <> was and not contains(text, '[REDACTED]')").count() == 0
    assert both.where("n_chars <> length(text)").count() == 0


def test_run_and_registration(spark, data):
    found = corpus_pipeline.run(spark, data)
    assert found.count() > 0 and found.where("taken > 2 * size").count() == 0
    names = __spark_entry__.queries()
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "benchmark_decontamination", "secret_scan", "mix_sources"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_near_copies_share_five_words_and_80_percent(spark, data):
    words = [f"w{i}" for i in range(100)]
    texts = {1: words, 2: [*words[:50], "x", *words[51:]], 3: [*words[:30], "x", *words[31:60], "y", *words[61:]], 4: [*words[:20], "x", *words[21:40], "y", *words[41:60], "z", *words[61:80], "v", *words[81:]], 5: ["other"] * 4, 6: [f"v{i}" for i in range(40)]}
    texts[7] = [*texts[6][:20], "x", *texts[6][21:]]
    sets = {i: {tuple(t[j : j + 5]) for j in range(max(len(t) - 4, 1))} for i, t in texts.items()}
    links = {i: [j for j in sets if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    assert links == {1: [1, 2, 3], 2: [1, 2], 3: [1, 3], 4: [4], 5: [5], 6: [6], 7: [7]}
    docs = spark.createDataFrame([(i, " ".join(t), "en", "a", 1) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, data).collect()) == [1, 4, 5, 6, 7]


def test_stages_take_nulls_and_no_rows(spark, data):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (None, "the and of that", "en", "a", 15), (None, "the and of that", "en", "a", 15), (2, "", "en", None, 0), (3, "the and of that is here", "en", "b", 23)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, data)
            df.count()


def shingles(text, k=5):
    w = re.findall("[^ \t-\r]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, lang_pred string, row int"


def test_rows_of_one_id_are_decided_each_and_other_columns_stay(spark, data):
    english = "the cat and the dog are in the house and that is what they want to be in for the night"
    other = "it was the best of times and it was the worst of times when they were at sea with the rest"
    third = "all of the people in this town have said that they would like to see more of the same"
    passage = spark.read.parquet(f"{data}/benchmark.parquet").where("size(split(text, ' ')) > 12").first().text
    rows = [(1, english), (2, english), (2, other), (None, third), (None, third + " " + passage), (4, third + " " + passage), (5, other + " and"), (6, None), (7, ""), (6, None), (None, english)]
    docs = spark.createDataFrame([(i, t, "en", "a", 5, 42.0, "xx", n) for n, (i, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = corpus_pipeline.language_id(spark, docs, data)
    assert got.columns == docs.columns and {(r.score, r.lang_pred) for r in got.collect()} == {(42.0, "xx")} and {r.row for r in got.collect()} == {0, 1, 2, 3, 4, 5, 6, 10}
    got = {r.row for r in corpus_pipeline.near_duplicates(spark, docs, data).collect()}
    assert got == {0, 2, 3, 5, 7, 8, 9}
    got = {r.row for r in corpus_pipeline.benchmark_decontamination(spark, docs, data).collect()}
    assert got == {0, 1, 2, 3, 6, 7, 8, 9, 10}
    got = corpus_pipeline.secret_scan(spark, docs, data)
    assert got.columns == docs.columns and {(r.row, r.score) for r in got.collect()} == {(i, 42.0) for i in range(11)} and {r.n_chars for r in got.where("text is null").collect()} == {5}
    assert corpus_pipeline.mix_sources(spark, docs, data).count() == 11


def test_the_run_is_that_of_brute_force(spark, data):
    """Near copies, passages and the mix by plain Python; the two learnt stages by their operators' rows."""
    from envlake.llm import langid, secrets

    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    rows = [r for r in docs.collect() if (p := model.predict(r.text))[0] != "und" and p[1] >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    sets = {r.doc_id: shingles(r.text) for r in rows}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if least[j] < least[i] and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    least[i], changed = least[j], True
    rows = [r for r in rows if least[r.doc_id] == r.doc_id]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {tuple(w[i : i + 10]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect() for w in [words(r.text)] if w for i in range(max(len(w) - 9, 1))}
    rows = [r for r in rows if not any(tuple(w[i : i + n]) in windows for w in [words(r.text)] for n in {len(x) for x in windows} for i in range(len(w) - n + 1))]
    kept = spark.createDataFrame(rows, docs.schema)
    clean = secrets.Scanner(spark, secrets.dictionary_words(kept)).redact(kept).collect()
    sizes = {r.doc_id: len(re.findall("[^ \t-\r]+", r.text or "")) for r in clean}
    of = {}
    for r in clean:
        of[r.source] = of.get(r.source, 0) + sizes[r.doc_id]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = 1.5 * sum(of.values()) - sum(2 * of[s] for s in full)
        target = {s: 2 * of[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        more = {s for s in names if s not in full and target[s] > 2 * of[s]}
        if not more:
            break
        full |= more
    got = corpus_pipeline.run(spark, data).collect()
    assert {(r.doc_id, r.size, r.source_size) for r in got} == {(r.doc_id, sizes[r.doc_id], of[r.source]) for r in clean}
    for s in names:
        own = [r for r in got if r.source == s]
        assert abs(own[0].target - target[s]) < 1e-6 * max(target[s], 1) and sum(r.taken for r in own) == int(own[0].target)
        assert all(r.taken <= 2 * r.size for r in own)
