"""License scan by diagonal voting.

All rolling word k-grams of every text are hashed and joined with the k-grams of
license templates, tables both; the templates' are sent to the texts while they are
small in bytes (MOST_SENT), else both are shuffled. A hit at
word p of the text and t of the template votes for the diagonal p - t. Votes are
summed by diagonal before the shuffle; neighbouring diagonals, as words left out
or put in make them, are merged; spans with enough of a template are read again
from the text and compared word by word.

Templates are license texts and notices, matched in part, and phrases, matched
whole with two-word grams. Words are those of ALNUM in text.py.

Defined results: a null or empty text has no words and no license; copies of a
row give equal rows; a label counts once however often it is found; a null id is an
id like any other; other columns, whatever their names, play no part. Long texts go
through the join in rows of some thousand words; a task that splits or verifies a
text holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lm import likely_rows
from .store import small_batches, written
from .text import ALNUM, grams, hash_words, pieces, split_words

#: Phrases that name a license wherever they stand.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: Public license texts and notices, or the part that tells them apart.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
]

#: Bytes of the templates' grams that are sent to every task, at most, and of each.
MOST_SENT, GRAM_BYTES = 8 << 20, 16
#: Words in a gram of a template, and of a phrase.
K, PHRASE_K = 4, 2
#: Diagonals so near one another are one alignment.
NEAR = 6
#: Least share of a template's words that must stand in a span.
COVERED = 0.75
#: Words of a text that go through the join in one row.
ROW_WORDS = 8192


Texts = list[tuple[str, str]] | DataFrame


def template_table(spark: SparkSession, phrases: Texts = PHRASES, templates: Texts = TEMPLATES) -> DataFrame:
    """(template, label, phrase, text, size): templates of (label, text) lists or tables, with their number of words; those without words are left out."""
    table = lambda x: x.select("label", "text") if isinstance(x, DataFrame) else spark.createDataFrame(x, "label string, text string")
    both = table(phrases).withColumn("phrase", F.lit(True)).unionByName(table(templates).withColumn("phrase", F.lit(False)))
    held = both.withColumn("size", n_words(F.col("text")).cast("int")).where("size > 0")
    return written(held.withColumn("template", F.monotonically_increasing_id()).select("template", "label", "phrase", "text", "size"), "templates")


def template_grams(templates: DataFrame) -> DataFrame:
    """(hash, template, t) of every k-gram, at word t, of a template_table()."""

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                words = split_words(batch.column(2).slice(a, b - a), ALNUM)
                hashes = hash_words(words)
                for i, x, y in zip(range(a, b), words.first[:-1], words.first[1:], strict=True):
                    found = grams(hashes[x:y], min(PHRASE_K if batch.column(1)[i].as_py() else K, int(y - x))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), batch.column(0)[i].as_py())), pa.array(np.arange(len(found), dtype=np.int32))], names=["hash", "template", "t"])

    return templates.select("template", "phrase", "text").mapInArrow(roll, "hash bigint, template bigint, t int")


def _rolling(docs: DataFrame) -> DataFrame:
    """(rid, more, base, short, grams): for some words of a text from base on, first the two-word grams, short of them, then the k-word ones."""
    schema = pa.schema([("rid", pa.int64()), ("more", pa.int64()), ("base", pa.int32()), ("short", pa.int32()), ("grams", pa.list_(pa.int64()))])

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                words = split_words(batch.column(2).slice(a, b - a), ALNUM)
                hashes = hash_words(words)
                rid, base, short, ends, parts = [], [], [], [0], []
                for key, i, j in zip(range(a, b), words.first[:-1], words.first[1:], strict=True):
                    two, long = grams(hashes[i:j], PHRASE_K), grams(hashes[i:j], K)
                    for at in range(0, len(two), ROW_WORDS):
                        x, y = two[at : at + ROW_WORDS], long[at : at + ROW_WORDS]
                        rid.append(key)
                        base.append(at)
                        short.append(len(x))
                        parts += [x, y]
                        ends.append(ends[-1] + len(x) + len(y))
                flat = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                keys = [batch.column(i).take(pa.array(rid, pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(base, pa.int32()), pa.array(short, pa.int32()), lists], schema=schema)

    return docs.mapInArrow(roll, "rid bigint, more bigint, base int, short int, grams array<bigint>")


def find_spans(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(rid, more, template, first, last): spans of words with enough votes, from (rid, more, text) rows; rid and more are a row's key."""
    known = written(template_grams(templates), "grams")
    shape = templates.select("template", "phrase", "size")
    if known.count() * GRAM_BYTES <= MOST_SENT:
        known, shape = F.broadcast(known), F.broadcast(shape)
    row = ["rid", "more"]
    rolled = _rolling(docs).select(*row, "base", "short", F.posexplode("grams").alias("j", "hash"))
    at = F.col("base") + F.when(F.col("j") < F.col("short"), F.col("j")).otherwise(F.col("j") - F.col("short"))
    hits = rolled.join(known, "hash").select(*row, "template", "t", at.alias("p"))
    lines = hits.groupBy(*row, "template", (F.col("p") - F.col("t")).alias("diagonal")).agg(F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("t").alias("ts"))
    lines = lines.join(shape, "template")
    order = Window.partitionBy(*row, "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR)
    lines = lines.withColumn("alignment", F.sum(F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).over(order))
    merged = lines.groupBy(*row, "template", "alignment", "phrase", "size").agg(F.min("low").alias("first"), F.max("high").alias("last"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"))
    k = F.least(F.when(F.col("phrase"), PHRASE_K).otherwise(K), F.col("size"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + k - 1)))))
    enough = F.when(F.col("phrase"), covered == F.col("size")).otherwise(covered >= F.lit(COVERED) * F.col("size"))
    return merged.where(enough).select(*row, "template", "first", (F.col("last") + k).alias("last"))


def n_words(text: Column) -> Column:
    """How many words a text has."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        held = pa.array(texts, pa.string(), from_pandas=True)
        counts = [np.diff(split_words(held.slice(a, b - a), ALNUM).first) for a, b in pieces(held)]
        return pd.Series(np.concatenate(counts) if counts else np.zeros(0, np.int64))

    return count(text)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: Texts = PHRASES, templates: Texts = TEMPLATES) -> DataFrame:
    """A row for each document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    phrases and templates: lists or tables of (label, text), license names matched whole, and license texts matched in part.
    """
    small_batches(docs.sparkSession)
    known = template_table(docs.sparkSession, phrases, templates)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("rid"), F.xxhash64(F.lit("more"), text, doc_id).alias("more"), F.col(text).alias("text"))
    spans = find_spans(keyed.select("rid", "more", "text"), known).join(known.select("template", "label", "phrase", F.col("text").alias("want")), "template")
    spans = spans.groupBy("rid", "more").agg(F.sort_array(F.collect_set(F.struct("template", "first", "last", "label", "phrase", "want"))).alias("spans"))
    spans = written(spans, "spans", narrow=True)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                words = split_words(pa.array([text])).strings().to_pylist()
                kept = []
                for s in found:
                    want, have = split_words(pa.array([s["want"]])).strings().to_pylist(), words[s["first"] : s["last"]]
                    if s["phrase"]:
                        share = float(have == want)
                    else:
                        share = sum(m.size for m in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks()) / max(len(want), len(have))
                    if share >= COVERED:
                        kept.append({"label": s["label"], "phrase": s["phrase"], "first": s["first"], "last": s["last"], "score": share})
                out.append(kept)
            kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, kind)], names=["rid", "more", "spans"])

    # few texts have a span, so those that can't are left where they are
    able = likely_rows(keyed.select(F.col("rid").alias("doc_id"), "more", "text"), spans.select(F.col("rid").alias("doc_id"))).withColumnRenamed("doc_id", "rid")
    checked = able.join(spans, ["rid", "more"]).select("rid", "more", "text", "spans").mapInArrow(verify, "rid bigint, more bigint, spans array<struct<label:string,phrase:boolean,first:bigint,last:bigint,score:double>>")
    checked = written(checked.dropDuplicates(["rid", "more"]), "licenses")
    base = F.filter(F.coalesce("spans", F.array().cast("array<struct<label:string,phrase:boolean,first:bigint,last:bigint,score:double>>")), lambda s: s["phrase"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    rows = keyed.select("doc_id", "rid", "more", n_words(F.col("text")).alias("n_words")).join(checked, ["rid", "more"], "left").withColumn("base", base)
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["first"])).alias("last_word"),
        joined(F.transform("base", lambda s: s["label"])).alias("base_labels"),
        F.coalesce(joined(F.transform("spans", lambda s: s["label"])), F.lit("")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
        "spans",
    )
