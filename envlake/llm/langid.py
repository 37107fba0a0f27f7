"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams of one to three letters (other characters count as one space)
are hashed into 2**bits features, an argument. Document frequencies come from all documents
that may be learnt from. The classifier is fitted on a bounded sample of them by
the follow-the-regularised-leader rule with elastic-net penalties, one weight
vector for each language, and a temperature fitted on a part that the training
leaves out turns its scores into probabilities.

Defined results: a text that is null or has no letter gets "und" and score 0;
without any labelled text every document gets "und"; whole texts are read, a
stretch at a time, whatever their length; rows are predicted from their text alone,
so copies get equal rows; of equally likely languages the first by name is taken.
predict() takes the place of columns that have the names of its results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import small_batches

#: Features are hashes of so many bits, unless a caller says otherwise: enough for some tens of languages; more scripts need more.
BITS = 15
#: Characters of a text that are read together.
STRETCH = 1 << 18
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 2e-4, 1e-5

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, its lower case if it is a letter, else the space."""
    if not _LETTERS:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x20000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        table[0x20000:0x323B0] = np.arange(0x20000, 0x323B0)
        _LETTERS.append(table)
    return _LETTERS[0]


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray] | None:
    """The hashed n-grams of a text, in order, and how often each occurs; None if it has no letter."""
    if not text:
        return None
    counts, tail, space = np.zeros(1 << bits, np.int64), np.zeros(0, np.uint32), np.full(1, 32, np.uint32)
    some = False
    for at in range(0, len(text), STRETCH):
        c = letters()[np.frombuffer(text[at : at + STRETCH].encode("utf-32-le", "replace"), np.uint32)]
        before = tail[-1:] if len(tail) else space
        c = c[(c != 32) | (np.concatenate([before, c[:-1]]) != 32)]
        some = some or bool((c != 32).any())
        first = space if not at else c[:0]
        last = space if at + STRETCH >= len(text) else c[:0]
        tail = _count(counts, tail, np.concatenate([first, c, last]), bits)
    if not some:
        return None
    at = np.flatnonzero(counts)
    return at, counts[at]


def _count(counts: np.ndarray, tail: np.ndarray, new: np.ndarray, bits: int) -> np.ndarray:
    """Adds the n-grams that end in the new letters, which follow the tail, and gives the last two letters of both."""
    c, old = np.concatenate([tail, new]), len(tail)
    one = c * np.uint32(0x9E3779B1)
    two = one[:-1] * np.uint32(31) + c[1:] * np.uint32(0x85EBCA6B) + np.uint32(7)
    three = two[:-1] * np.uint32(33) + c[2:] * np.uint32(0xC2B2AE35) + np.uint32(11)
    h = np.concatenate([one[old:], two[max(old - 1, 0) :], three[max(old - 2, 0) :]])
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts += np.bincount(h >> np.uint32(32 - bits), minlength=1 << bits)
    return c[-2:]


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x labels
    temperature: float = 1.0

    @property
    def bits(self) -> int:
        return len(self.idf).bit_length() - 1

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return x / max(np.sqrt((x * x).sum()), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text, self.bits)
        if found is None or not self.labels:
            return "und", 0.0
        p = softmax(self.vector(*found) @ self.weights[found[0]] / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(labels: list[str], idf: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """The model of (label number, features, counts) rows, taken in the given order."""
    model = Model(labels, idf, np.zeros((len(idf), len(labels))))
    vectors = [(y, at, model.vector(at, counts)) for y, at, counts in rows]
    train, held = [v for i, v in enumerate(vectors) if i % 5], vectors[::5]
    z, n, w = (np.zeros((len(idf), len(labels))) for _ in range(3))
    for _ in range(EPOCHS):
        for y, at, x in train:
            zs, ns = z[at], n[at]
            own = np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))
            error = softmax(x @ own)
            error[y] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[at] = zs + g - sigma * own
            n[at] = ns + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    model.weights = w.astype(np.float32)
    if held:
        scores, truth = np.array([x @ w[at] for _, at, x in held]), np.array([y for y, _, _ in held])
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 93))
        loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def document_frequencies(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(feature int, n long) over all texts: each task sums its own counts before the shuffle."""
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = features(text, bits)
                if found is not None:
                    total[found[0]] += 1
                    texts += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1).astype(np.int32)), pa.array(np.append(total[held], texts))], schema=schema)

    return docs.select("text").mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", most_texts: int = 800, most_rows: int = 20_000, bits: int = BITS) -> Model:
    """A model of the rows for which learn is true and lang is not null.

    Document frequencies cover all of them; the classifier is fitted on those of each
    language that come first by a hash of their key, most_texts at most, and most_rows of
    all languages together (but one of each); every fifth sets the temperature. These
    bounds, and 2**bits features for each language, are what the driver holds.
    """
    small_batches(docs.sparkSession)
    known = docs.where(learn & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("turn"))
    counts = {r.feature: r.n for r in document_frequencies(known, bits).collect()}
    texts = counts.pop(-1, 0)
    frequency = np.zeros(1 << bits)
    frequency[list(counts)] = list(counts.values())
    idf = np.log((1 + texts) / (1 + frequency)) + 1

    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # The turns are uniform, so a threshold a little above the wanted share leaves few rows to sort.
    most = max(1, min(most_texts, most_rows // max(len(sizes), 1)))
    shares = {name: min(1.0, 1.3 * most / n + 30 / n) * 2**32 for name, n in sizes.items()}
    if not shares:
        return Model([], idf, np.zeros((1 << bits, 0)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, bits) for t in batch.column(0).to_pylist()]
            at = pa.array([None if x is None else x[0].astype(np.int32) for x in found], pa.list_(pa.int32()))
            held = pa.array([None if x is None else np.minimum(x[1], 2**31 - 1).astype(np.int32) for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), at, held], names=["lang", "turn", "at", "n"])

    least = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    sample = known.where(F.conv(F.substring("turn", 1, 8), 16, 10).cast("double") < least)
    made = sample.mapInArrow(vectors, "lang string, turn string, at array<int>, n array<int>").where("at is not null")
    sample = made.toArrow().combine_chunks()
    held = [(turn, name, *(sample[c][i].values.to_numpy() for c in ("at", "n"))) for i, (name, turn) in enumerate(zip(sample["lang"].to_pylist(), sample["turn"].to_pylist(), strict=True))]
    rows, taken = [], dict.fromkeys(sizes, 0)
    for _, name, at, n in sorted(held, key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes())):
        if taken[name] < most:
            taken[name] += 1
            rows.append((name, at, n))
    number = {name: i for i, name in enumerate(sorted({r[0] for r in rows}))}
    return fit(list(number), idf, [(number[name], at, n) for name, at, n in rows])


def predict(docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with a label and its score, from the text alone, in columns of the given names."""
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.idf, model.weights, model.temperature))

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts):
        import pandas as pd

        own = Model(*shared.value)
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in (label, score)]
    held = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], guess(F.col(text)).alias("guess"))
    return held.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("guess.lang_pred").alias(label), F.col("guess.score").alias(score))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
