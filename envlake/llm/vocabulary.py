"""Counts of words over all texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches, written
from .text import ALNUM, pieces, split_words


def word_counts(texts: DataFrame) -> DataFrame:
    """(word string, n long) from a table whose one column is text; tasks count their own words first."""
    small_batches(texts.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(0), 4 << 20):
                found = pc.value_counts(split_words(batch.column(0).slice(a, b - a), ALNUM).strings())
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], schema=schema)

    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(texts: DataFrame, most: int, where: str = "true") -> list[str]:
    """The most frequent words, at most so many and in order of the alphabet; of equally frequent ones those with the smallest hashes.

    The driver sees how many words have each count, a class of counts at a time, and the chosen words.
    """
    table = written(word_counts(texts).where(where).withColumns({"class": F.floor(F.log2("n") * 8).cast("int"), "turn": F.pmod(F.xxhash64("word"), F.lit(2**32))}), "words")
    least, left = _boundary(table, "class", most)
    found = table.where("false") if least is None else table.where(F.col("class") > least)
    if least is not None and left:
        last = table.where(F.col("class") == least)
        n, left = _boundary(last, "n", left)
        found = found.union(last.where(F.col("n") > n))
        if left:
            ties = last.where(F.col("n") == n)
            # turns are uniform, so a threshold a little above the wanted share leaves few rows to sort
            share = min(1.0, (1.3 * left + 30) / ties.count()) * 2**32
            first = sorted((r.turn, r.word) for r in ties.where(F.col("turn") <= share).select("turn", "word").collect())[:left]
            return sorted([*(r.word for r in found.select("word").collect()), *(w for _, w in first)])
    return sorted(r.word for r in found.select("word").collect())


def _boundary(table: DataFrame, column: str, most: int) -> tuple[int | None, int]:
    """(the value from which on there are most rows or more, or the smallest one; how many rows of it are wanted)."""
    left, last = most, None
    for r in table.groupBy(column).agg(F.count("*").alias("words")).orderBy(F.desc(column)).collect():
        last = r[column]
        if r.words >= left:
            return last, left
        left -= r.words
    return (None, 0) if last is None else (last - 1, 0)
