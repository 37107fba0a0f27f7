"""Filter interaction audit by Walsh-Hadamard sums.

Every document gets a mask, one bit for each filter that it fails. For each subset S
of the filters, a part's documents are summed with the sign (-1)^|mask & S|: 32
signed parity sums per part and label for five filters, combined before the shuffle
and as many for a million documents as for ten. The transform is its own inverse but
for a factor, so the sums give back the exact number of documents with every mask.
From these cells all orders of the filters are evaluated without another look at the
documents: what a filter removes after those before it, what it would have removed
alone, and Shapley totals, for which an order is no matter: of a document that fails k
filters, each of them comes first in 1/k of all orders.

Defined results: a null text is empty, a null part the empty string; equal texts are
those with one SHA-256, whatever their parts; a row without an id is no copy of
another and none is a copy of it; of rows that share the smallest id none is a copy;
a document has a label if any of its rows in labels has; labels without an id or a
document count nowhere; repeated rows are documents of their own; an empty table has
no parts and gives no rows; texts of any length are read whole; other columns,
whatever their names, play no part.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written
from .text import BLACK_WORD

FILTERS = "ABCDE"
#: Limits of the filters: fewest words, least percent of distinct words, most percent of capitals.
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
MARKS = "[#$%&*|]"


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, mask): bits 1, 2, 4, 8, 16 for the filters A to E that a document fails.

    Copies are found by digest: the smallest id of each is an aggregate combined before
    the shuffle, and goes back by digest and id together, so that the copies of a text,
    however many, are dealt over all tasks.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), body.alias("body"))
    rows = rows.withColumn("words", F.regexp_extract_all("body", F.lit(BLACK_WORD), F.lit(0)))
    n = F.size("words")
    failed = [
        n < FEWEST_WORDS,
        100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * n,
        100 * F.regexp_count("body", F.lit("[A-Z]")) > MOST_CAPITALS * F.length("body"),
        F.col("body").rlike(MARKS),
    ]
    mask = reduce(add, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)])
    masked = written(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("body", 256)).alias("digest")), "masks")
    first = masked.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return masked.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << len(failed)).otherwise(0)).alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with `good` and `toxic`, from labels (doc_id, quality, toxic)."""
    own = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    found = rows.join(own, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return found.fillna(False, ["good", "toxic"])


def _sign(mask: Column, subset: Column) -> Column:
    return 1 - 2 * (F.bit_count(mask.bitwiseAND(subset)) % 2)


def parity_sums(rows: DataFrame, filters: int) -> DataFrame:
    """(part, good, toxic, sums): for each subset of the filters, the rows summed with the sign of their parity in it."""
    sums = [F.sum(_sign(F.col("mask"), F.lit(s)).cast("bigint")) for s in range(1 << filters)]
    return rows.groupBy("part", "good", "toxic").agg(F.array(*sums).alias("sums"))


def cells(sums: DataFrame, filters: int) -> DataFrame:
    """(part, n, good, toxic): the number of documents with each mask, all and by label, from the inverse transform."""
    subsets = F.sequence(F.lit(0), F.lit((1 << filters) - 1))
    signed = lambda m: F.aggregate(F.arrays_zip(subsets.alias("s"), F.col("sums").alias("w")), F.lit(0).cast("bigint"), lambda total, x: total + x["w"] * _sign(x["s"], m))
    exact = sums.select("part", "good", "toxic", F.transform(subsets, lambda m: F.shiftright(signed(m), filters)).alias("cell"))
    each = lambda of: F.array(*[F.coalesce(F.sum(F.when(of, F.col("cell")[i])), F.lit(0).cast("bigint")) for i in range(1 << filters)])
    return exact.groupBy("part").agg(each(F.lit(True)).alias("n"), each(F.col("good")).alias("good"), each(F.col("toxic")).alias("toxic"))


def evaluate(found: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from cells()."""
    steps, kind = [], "filter_order string, step int, own int, before int"
    for order in permutations(range(len(filters))):
        for i, f in enumerate(order):
            steps.append({"filter_order": "".join(filters[x] for x in order), "step": i + 1, "own": 1 << f, "before": sum(1 << x for x in order[:i])})
    rows = found.withColumn("at", F.explode(F.from_json(F.lit(json.dumps(steps)), f"array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>"))).select("*", "at.*")
    masks, orders = range(1 << len(filters)), factorial(len(filters))

    def total(of: str, when) -> Column:
        return reduce(add, [F.when(when(F.lit(m)), F.col(of)[m]).otherwise(F.lit(0).cast("bigint")) for m in masks])

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    spared = lambda m: m.bitwiseAND(F.col("before")) == 0
    removed = lambda m: fails(m) & spared(m)
    shapley = reduce(add, [F.when(fails(F.lit(m)), F.col("n")[m] * (orders // m.bit_count())).otherwise(F.lit(0).cast("bigint")) for m in masks if m])
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: spared(m) & ~fails(m)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: fails(m) & ~spared(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    sums = parity_sums(labelled(failures(docs), labels), len(filters))
    return evaluate(cells(sums, len(filters)), filters)
