"""Mixing sources to target weights.

Documents get hash-random keys and are range-sorted by source and key over all tasks.
Token counts are summed for each task's part of a source, those sums are summed up in
order, and a running sum inside each part completes the prefix sums. No source is
sorted in one task, and copies of a row, however many, are dealt over tasks. A source
is cut at its exact budget: whole epochs first, then the documents up to the budget,
the last one in part. Sources are ranked in the same way, so their number has no limit.

Defined results: a null or empty text has size 0 and nothing is taken of it; null
is a source of its own, the last; a source without words has target 0; repeated
rows are separate documents, and which of two identical rows comes first does not
show in the result; rows without an id, or with one id, are told apart by their
text; other columns, whatever their names, play no part, and of a text, however
long, only its size and digest go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_positions, prefix_sums
from .store import written
from .text import BLACK_WORD

def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row for each source.

    Sources, in code point order with null last, get the weights in turn. They
    split share * all sizes by weight; a source stops at epochs times its size, and
    the excess goes to the others by weight until none is above. Each round is an
    aggregate of which the driver sees one row.
    """
    ranked = dense_positions(sizes, [F.col("source").asc_nulls_last()], name="place")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    table = written(ranked.withColumn("weight", turn).drop("place").withColumn("cap", F.col("source_size") * F.lit(float(epochs))), "sources")
    budget = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * share).first()[0]
    level, last = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        n, capped, rest = table.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == last or rest is None:
            break
        level, last = (float(budget) - capped) / rest, n
    return table.select("source", "source_size", "weight", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def mix_sources(docs: DataFrame, size: Column, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2, seed: str = "mix", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken): the words the mix takes of each document."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text) if c in docs.columns]
    key = F.md5(F.concat_ws(":", F.lit(seed), own[0], F.md5(own[-1])))
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.cast("bigint").alias("size"), key.alias("key")), "sized", narrow=True)
    targets = written(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs), "targets")
    before = prefix_sums(sized, "size", ["key", "size"], ["source"])
    placed = before.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    words = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("bigint")
    left = words - whole * F.col("source_size") - F.col("before")
    taken = whole * F.col("size") + F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "size", "source", "source_size", "target", taken.cast("bigint").alias("taken"))


def black_words(text: str = "text") -> Column:
    """The number of words of anything but white space."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(BLACK_WORD))
