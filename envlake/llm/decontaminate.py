"""Benchmark decontamination with a distributed positional inverted index.

The index is a written table of shards. A shard holds some whole documents: for
each term the sorted word positions at which it stands, numbered through the
shard. Test windows are looked up in every shard by themselves, so nothing is
shuffled: a window starts from the postings of its rarest term, moves them by
that term's offset, and keeps those that the moved postings of the next rarest
terms confirm. Windows come in blocks of a bounded size; a block is broadcast, its
hits are written, and it is let go before the next one, so the driver and a task
hold one block whatever the size of the test set.

Defined results: a null or empty text has no words and no hits; a repeated
document gives a row for each copy; an item without an id counts for n_hit but
not among the items; an empty benchmark hits nothing; a null id is kept; other
columns, whatever their names, play no part. A longer text than a shard's size is a
shard by itself, which a task holds whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import small_batches, written
from .text import ALNUM, ALNUM_WORD, pieces, split_words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INDEX_SCHEMA = "shard string, ids array<bigint>, first array<bigint>, terms array<binary>, begin array<bigint>, postings binary"
HITS_SCHEMA = "shard string, row int, doc_id bigint, n_words bigint, spans array<struct<at:bigint,upto:bigint>>, items array<string>"
#: Windows in a block that is broadcast: about 10 terms of 10 bytes each, so some 8 MB.
BLOCK = 50_000
#: Postings looked at together in a task.
TOGETHER = 1 << 19


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(ALNUM_WORD), F.lit(0))


def test_windows(items: DataFrame, n: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window array<string>, items array<string>): the distinct windows of n words, each with the items that have it."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(n - 1), F.lit(1)))
    w = w.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, n))).alias("window"))
    return w.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = 4 << 20) -> DataFrame:
    """Postings of every word of all documents: a row for each shard of about shard_bytes."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("shard", pa.string()), ("ids", pa.list_(pa.int64())), ("first", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())), ("begin", pa.list_(pa.int64())), ("postings", pa.binary())])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in pieces(texts, shard_bytes):
                words = split_words(texts.slice(a, b - a), ALNUM)
                coded = words.arrow().dictionary_encode()
                own, code = coded.dictionary, coded.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                counts = np.bincount(code, minlength=len(own))
                held = np.flatnonzero(counts)
                begin = np.concatenate([[0], np.cumsum(counts[held])]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{part}-{count}"]),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a)),
                        pa.array([words.first.tolist()], pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), own.take(pa.array(held))),
                        pa.array([begin.tolist()], pa.list_(pa.int64())),
                        pa.array([order.astype("<i4").tobytes()], pa.binary()),
                    ],
                    schema=schema,
                )
                count += 1

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(shards, INDEX_SCHEMA)


def term_counts(index: DataFrame) -> DataFrame:
    """(term binary, n long): how often each indexed term occurs in all documents."""
    pairs = F.arrays_zip(F.col("terms").alias("term"), F.slice("begin", 1, F.size("terms")).alias("a"), F.slice("begin", 2, F.size("terms")).alias("b"))
    return index.where("size(terms) > 0").select(F.explode(pairs).alias("x")).groupBy(F.col("x.term").alias("term")).agg(F.sum(F.col("x.b") - F.col("x.a")).alias("n"))


def ordered_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, window, items, rank): rank has the offsets of a window's words from the rarest term on; windows with a term that never occurs are gone."""
    terms = windows.withColumn("id", F.xxhash64("window")).select("id", "window", "items", F.posexplode("window").alias("at", "term"))
    known = terms.withColumn("term", F.encode("term", "UTF-8")).join(counts, "term")
    ranked = known.groupBy("id", "window").agg(F.first("items").alias("items"), F.array_sort(F.collect_list(F.struct("n", "at"))).alias("r"))
    return ranked.where("size(r) = size(window)").select("id", "window", "items", F.col("r.at").alias("rank"))


class _Block:
    """Windows as arrays; built once in a task."""

    def __init__(self, rows: list[tuple[list[str], list[str], list[int]]]):
        self.items = [r[1] for r in rows]
        self.terms = sorted({w.encode() for r in rows for w in r[0]})
        code = {t: i for i, t in enumerate(self.terms)}
        width = max((len(r[0]) for r in rows), default=1)
        self.length = np.array([len(r[0]) for r in rows], np.int64)
        self.term = np.full((len(rows), width), -1, np.int64)  # by rank
        self.offset = np.zeros((len(rows), width), np.int64)
        for i, (window, _, rank) in enumerate(rows):
            self.term[i, : len(rank)] = [code[window[j].encode()] for j in rank]
            self.offset[i, : len(rank)] = rank
        self.arrow = pa.array(self.terms, pa.binary())


def _matches(block: _Block, terms: pa.Array, begin: np.ndarray, postings: np.ndarray, first: np.ndarray, doc_of: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first word, word after the last) of every match in a shard."""
    code = pc.fill_null(pc.index_in(terms, value_set=block.arrow), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    lists = np.flatnonzero(code >= 0)
    lists = lists[np.argsort(code[lists])]
    starts = np.full(len(block.terms), -1, np.int64)
    counts = np.zeros(len(block.terms), np.int64)
    sizes = begin[lists + 1] - begin[lists]
    at = np.concatenate([[0], np.cumsum(sizes)])
    starts[code[lists]], counts[code[lists]] = at[:-1], sizes
    pos = np.concatenate([postings[begin[i] : begin[i + 1]] for i in lists]).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    keys = (np.repeat(code[lists], sizes) << 32) + pos
    alive = np.flatnonzero(((block.term < 0) | (counts[block.term] > 0)).all(axis=1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = counts[block.term[alive, 0]]
    group = np.cumsum(n) // TOGETHER
    for g in np.unique(group):
        own = alive[group == g]
        n = counts[block.term[own, 0]]
        window = np.repeat(own, n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        base = pos[np.repeat(starts[block.term[own, 0]], n) + within] - block.offset[window, 0]
        low, high = base + block.offset[window, 0], base + block.offset[window, 0]
        begins, ends = first[doc_of[low]], first[doc_of[low] + 1]  # a match stays in its document
        for r in range(1, block.term.shape[1]):
            term, want = block.term[window, r], base + block.offset[window, r]
            i = np.searchsorted(keys, (term << 32) + np.clip(want, begins, ends - 1))
            after, before = (keys[np.clip(i - k, 0, len(keys) - 1)] - (term << 32) for k in (0, 1))
            # the posting nearest to the word's place, of the two around it
            fits = [(i - k >= 0) & (i - k < len(keys)) & (abs(got - want) <= slop) & (got >= begins) & (got < ends) for k, got in ((0, after), (1, before))]
            got = np.where(fits[0] & (~fits[1] | (after - want <= want - before)), after, before)
            ok = (term < 0) | fits[0] | fits[1]
            got = np.where(term < 0, low, got)
            window, base, begins, ends, low, high = window[ok], base[ok], begins[ok], ends[ok], np.minimum(low, got)[ok], np.maximum(high, got)[ok]
            if not len(window):
                break
        found.append((window, low, high + 1))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def search_block(index: DataFrame, shared: Broadcast, slop: int = 0) -> DataFrame:
    """A row for each document of the index: the merged spans of words that the windows match, and the items whose windows do.

    shared has the (window, items, rank) of the windows.
    """
    span = pa.struct([("at", pa.int64()), ("upto", pa.int64())])
    schema = pa.schema([("shard", pa.string()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                shard, ids, first, terms, begin, postings = (batch.column(j)[i] for j in range(6))
                ids, first, begin = ids.values, first.values.to_numpy(), begin.values.to_numpy()
                n_words = np.diff(first)
                doc_of = np.repeat(np.arange(len(ids)), n_words)
                window, low, high = _matches(block, terms.values, begin, np.frombuffer(postings.as_py(), "<i4"), first, doc_of, slop)
                spans: list[list[dict]] = [[] for _ in range(len(ids))]
                items: list[list[str]] = [[] for _ in range(len(ids))]
                if len(low):
                    order = np.argsort(low, kind="stable")
                    a, b, doc = low[order], np.maximum.accumulate(high[order]), doc_of[low[order]]
                    new = np.concatenate([[True], (a[1:] > b[:-1]) | (doc[1:] != doc[:-1])])
                    last = np.concatenate([new[1:], [True]])
                    for d, x, y in zip(doc[new], a[new], b[last], strict=True):
                        spans[d].append({"at": int(x - first[d]), "upto": int(y - first[d])})
                    pairs = np.unique(doc_of[low] * len(block.items) + window)
                    for d, w in zip(pairs // len(block.items), pairs % len(block.items), strict=True):
                        items[d] += block.items[w]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(ids)),
                        pa.array(np.arange(len(ids)), pa.int32()),
                        ids,
                        pa.array(n_words, pa.int64()),
                        pa.array(spans, pa.list_(span)),
                        pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                    ],
                    schema=schema,
                )

    return index.mapInArrow(look, HITS_SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0, doc_id: str = "doc_id") -> DataFrame:
    """A row for each document: doc_id, n_words, spans (words hit, from 0), n_hit, items, n_items, contaminated.

    slop 0 finds exact phrases; a larger one also finds windows whose words stand
    at most so many words from their places, as seen from the window's rarest word.
    """
    index = written(build_index(docs, doc_id), "postings", wide=True)
    ordered = written(ordered_windows(test_windows(benchmark, n), term_counts(index)), "windows")
    blocks = max(1, -(-ordered.count() // BLOCK))

    def block(b: int) -> Broadcast:
        own = ordered.where(F.pmod("id", F.lit(blocks)) == b) if blocks > 1 else ordered
        return index.sparkSession.sparkContext.broadcast([(list(r.window), list(r["items"]), list(r["rank"])) for r in own.collect()])

    found = search_block(index, block(0), slop)
    if blocks > 1:
        parts = [written(found, "hits")]
        for b in range(1, blocks):
            shared = block(b)
            parts.append(written(search_block(index, shared, slop).where("size(spans) > 0"), "hits", narrow=True))
            shared.destroy()
        found = reduce(DataFrame.unionByName, parts).groupBy("shard", "row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    start = F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("upto"))
    step = lambda acc, s: F.struct((acc["hit"] + F.greatest(s["upto"] - F.greatest(s["at"], acc["upto"]), F.lit(0))).alias("hit"), F.greatest(acc["upto"], s["upto"]).alias("upto"))
    n_hit = F.aggregate("spans", start, step)["hit"]
    return found.select("doc_id", "n_words", "spans", n_hit.alias("n_hit"), "items", F.size("items").cast("bigint").alias("n_items"), (n_hit > 0).alias("contaminated"))
