"""Language-model scoring by cross-entropy difference.

Two bigram models, one of target texts and one of all texts, share everything but
their counts: the vocabulary (all words of all texts and one token for any other,
unless a caller limits it) and the smoothing. A document's score is the mean over
its tokens of the loss under the target model minus that under the background
model: below 0 is more like the target.

Every word and every bigram of all documents has a count of its own; words are told
apart by 64 bits of hash, bigrams by their bucket and 48 bits. What is counted grows with the input,
so no task holds a model: a piece of texts sends each of its bigrams, with the
documents that hold it, to a bucket chosen by the bigram's second word. A bucket
has all bigrams that end in its words, therefore their counts and those of the
words, and returns to each piece the part of its documents' losses. The number of
buckets follows the number of tokens. The bigrams of a word that is frequent
enough to fill much of a bucket are spread over all of them; the counts of these
words, a few for each bucket, are broadcast.

Defined results: a text without words has 0 tokens and null losses and score;
repeated rows count and are scored each; without any target text the target model
is its smoothing alone; unlabelled documents are not targets; a null id is no
target's; other columns, whatever their names, play no part. A very long text is a
piece of its own, and a task holds about 60 bytes for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches, written
from .text import ALNUM, hash_words, mix, pieces, split_words
from .vocabulary import frequent_words

#: Weight of the unigram model in a bigram's probability; tokens in a bucket, about; bytes of text in a piece, about.
WEIGHT, BUCKET, PIECE = 50.0, 1 << 20, 6 << 20
#: Bits of the filter that tells target texts from most others before they are shuffled: 8 MB, whatever the number of targets.
FILTER_BITS = 1 << 26
#: The hashes that stand for a word outside a limited vocabulary and for the start of a text.
OTHER, START = np.uint64(0), np.uint64(1)

_ASKED = "piece bigint, bucket bigint, keys binary, words binary, runs binary, docs binary, doc binary, n binary, last binary, ids array<bigint>, tokens array<bigint>"


def gathered(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as larger ones of about PIECE bytes of text, which the column of that number holds."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= PIECE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def tokens(texts: pa.Array, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous token, token, first token of each text) of all texts, tokens as hashes; known: a limited vocabulary's, sorted."""
    words = split_words(texts, ALNUM)
    now = hash_words(words)
    if known is not None:
        now = np.where(np.isin(now, known), now, OTHER)
    before = np.concatenate([[START], now[:-1]])[: len(now)]
    before[words.first[:-1][np.diff(words.first) > 0]] = START
    return before, now, words.first


def counter(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """The key of each bigram."""
    return mix(before.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + now.astype(np.uint64))


def word_totals(texts: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(word, n): the counts of each token, and of starts, in the texts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 0):
            for a, b in pieces(batch.column(0), PIECE):
                _, now, first = tokens(batch.column(0).slice(a, b - a), known)
                word, n = np.unique(now, return_counts=True)
                word, n = np.append(word, START), np.append(n, (np.diff(first) > 0).sum())
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (word, n)], names=["word", "n"])

    return texts.select("text").mapInArrow(add, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _bucket(key: np.ndarray, now: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bigram goes: by its second word, or by itself if that word is frequent."""
    return (np.where(np.isin(now, frequent), key, mix(now)) % np.uint64(buckets)).astype(np.int64)


def _runs(words: np.ndarray) -> tuple[bytes, bytes]:
    """Equal neighbours as one word each and how many there are."""
    at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])[: len(words)])
    return words[at].tobytes(), np.diff(np.append(at, len(words))).astype(np.int32).tobytes()


def _six(keys: np.ndarray) -> bytes:
    """The lower six bytes of each key, which tell the bigrams of one bucket apart."""
    return keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(data) // 6, 8), np.uint8)
    keys[:, :6] = data.reshape(-1, 6)
    return keys.reshape(-1).view(np.uint64)


def target_bigrams(targets: DataFrame, known: np.ndarray | None, frequent: np.ndarray, buckets: int) -> DataFrame:
    """For some target texts and each bucket a row with their bigrams that go there: keys, words in runs, and n, their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 0):
            for a, b in pieces(batch.column(0), PIECE):
                before, now, _ = tokens(batch.column(0).slice(a, b - a), known)
                key, at, n = np.unique(counter(before, now), return_index=True, return_counts=True)
                now = now[at]
                chosen = _bucket(key, now, frequent, buckets)
                order = np.lexsort((key, now, chosen))  # equal words together, which compresses
                key, now, n = key[order], now[order], n[order].astype(np.int32)
                cuts = np.searchsorted(chosen[order], np.arange(buckets + 1))
                held = np.flatnonzero(np.diff(cuts))
                spans = [slice(cuts[i], cuts[i + 1]) for i in held]
                words, runs = zip(*(_runs(now[s]) for s in spans), strict=True) if spans else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array([_six(key[s]) for s in spans], pa.binary()), pa.array(words, pa.binary()), pa.array(runs, pa.binary()), pa.array([n[s].tobytes() for s in spans], pa.binary())], names=["bucket", "keys", "words", "runs", "n"])

    found = targets.select("text").mapInArrow(count, "bucket bigint, keys binary, words binary, runs binary, n binary")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    return found.select(none("piece", "bigint"), "bucket", "keys", "words", "runs", none("docs", "binary"), none("doc", "binary"), "n", none("last", "binary"), none("ids", "array<bigint>"), none("tokens", "array<bigint>"))


def bigrams(rows: DataFrame, known: np.ndarray | None, frequent: np.ndarray, buckets: int) -> DataFrame:
    """For each piece of texts a row with its documents, and one for each bucket with the bigrams that go there.

    keys: each bigram; words and runs: their second words, and how many bigrams in a row have each. docs: how many documents of the piece hold it; for each of
    these doc, n and last: which, how often, and whether it ends the document.
    """
    blobs = ("keys", "words", "runs", "docs", "doc", "n", "last")
    schema = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), *((x, pa.binary()) for x in blobs), ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, 1):
            for a, b in pieces(batch.column(1), PIECE):
                piece += 1
                before, now, first = tokens(batch.column(1).slice(a, b - a), known)
                size = np.diff(first)
                doc = np.repeat(np.arange(b - a), size)
                key = counter(before, now)
                ends = np.zeros(len(now), np.int64)
                ends[first[1:][size > 0] - 1] = 1
                chosen = _bucket(key, now, frequent, buckets)
                # occurrences in order of bucket, word, bigram and document
                order = np.lexsort((key, now, chosen))  # stable: documents stay in order
                key, now, doc, ends, chosen = key[order], now[order], doc[order], ends[order], chosen[order]
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (now[1:] != now[:-1])])[: len(key)]
                other = new | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(key)]
                at, held = np.flatnonzero(new), np.flatnonzero(other)
                where = np.concatenate([np.searchsorted(held, at), [len(held)]])
                n = np.diff(np.append(held, len(key))).astype(np.int32)
                last = (np.add.reduceat(ends, held) if len(held) else ends).astype(np.uint8)
                kind = np.uint16 if b - a <= 1 << 16 else np.uint32
                keys, words, docs, doc = key[at], now[at], np.diff(where).astype(np.int32), doc[held].astype(kind)
                cuts = np.searchsorted(chosen[at], np.arange(buckets + 1))
                rows: dict[str, list] = {x.name: [] for x in schema}
                for bucket in np.flatnonzero(np.diff(cuts)):
                    x, y = slice(cuts[bucket], cuts[bucket + 1]), slice(where[cuts[bucket]], where[cuts[bucket + 1]])
                    for name, value in zip(blobs, (_six(keys[x]), *_runs(words[x]), docs[x].tobytes(), doc[y].tobytes(), n[y].tobytes(), last[y].tobytes()), strict=True):
                        rows[name].append(value)
                    rows["bucket"].append(int(bucket))
                    rows["ids"].append(None)
                    rows["tokens"].append(None)
                for name in blobs:
                    rows[name].append(None)
                rows["bucket"].append(piece % buckets)
                rows["ids"].append(batch.column(0).slice(a, b - a).to_pylist())
                rows["tokens"].append(size.tolist())
                rows["piece"] = [piece] * len(rows["bucket"])
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return rows.select("doc_id", "text").mapInArrow(ask, _ASKED)


def score(rows: DataFrame, targets: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) of (doc_id, text) rows; targets: (text), those that the target model learns from."""
    shared_of = rows.sparkSession.sparkContext.broadcast
    own, every = word_totals(targets, known), word_totals(rows, known)
    totals = own.withColumnRenamed("n", "target").join(every.withColumnRenamed("n", "background"), "word", "full").na.fill(0, ["target", "background"])
    totals = written(totals, "totals")
    start = int(START)
    starts = totals.where(F.col("word") == start).agg(F.sum("target"), F.sum("background")).first()
    own = totals.where(F.col("word") != start)
    size = own.agg(F.sum("target"), F.sum("background"), F.count("*")).first()
    distinct = size[2] if known is None else len(known)
    buckets = max(1, ceil((size[1] or 0) / BUCKET))
    many = own.where(F.col("background") > BUCKET // 16).toArrow() if buckets > 1 else own.limit(0).toArrow()
    many = [many[x].to_numpy().astype(kind) for x, kind in (("word", np.uint64), ("target", np.int64), ("background", np.int64))]
    by_word = np.argsort(many[0])
    frequent = shared_of([x[by_word] for x in many])
    alone = [WEIGHT / ((n or 0) + distinct + 1) for n in size[:2]]
    first_loss = [log((n or 0) + WEIGHT) for n in starts]

    weighed = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), *((x, pa.binary()) for x in ("doc", "target", "background")), ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])

    def flat(column: pa.ChunkedArray, kind) -> np.ndarray:
        """The numbers of all blobs of a column, one after the other."""
        blobs = column.combine_chunks()
        ends = np.frombuffer(blobs.buffers()[1], np.int32, len(blobs) + 1, 4 * blobs.offset)
        return np.frombuffer(blobs.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind) if len(blobs) and blobs.buffers()[2] is not None else np.zeros(0, kind)

    def weigh(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {x: [] for x in ("piece", "bucket", "doc", "target", "background", "ids", "tokens")}
        records = table.filter(pc.is_null(table["keys"])).select(["piece", "ids", "tokens"])
        sent = table.filter(pc.is_valid(table["docs"]))
        learnt = table.filter(pc.and_(pc.is_valid(table["keys"]), pc.is_null(table["docs"])))
        del table
        if len(sent):
            docs, n = flat(sent["docs"], np.int32), flat(sent["n"], np.int32)
            every = np.add.reduceat(n.astype(np.int64), np.cumsum(docs) - docs)
            keys, pair = np.unique(_from_six(flat(sent["keys"], np.uint8)), return_inverse=True)
            word, code = np.unique(flat(sent["words"], np.uint64), return_inverse=True)
            code = np.repeat(code, flat(sent["runs"], np.int32))
            # target texts are among all texts, so their bigrams and words are among these
            their_n = flat(learnt["n"], np.int32)
            their_words = np.repeat(np.searchsorted(word, flat(learnt["words"], np.uint64)), flat(learnt["runs"], np.int32))
            pairs = [np.bincount(np.searchsorted(keys, _from_six(flat(learnt["keys"], np.uint8))), their_n, len(keys)), np.bincount(pair, every, len(keys))]
            singles = [np.bincount(their_words, their_n, len(word)), np.bincount(code, every, len(word))]
            del keys, every, their_n, their_words, learnt
            hot, *counts = frequent.value
            at = np.minimum(np.searchsorted(hot, word), max(len(hot) - 1, 0))
            is_hot = hot[at] == word if len(hot) else np.zeros(len(word), bool)
            pair_loss, word_loss = [], []
            for i in range(2):
                ones = singles[i]
                if is_hot.any():
                    ones[is_hot] = counts[i][at[is_hot]]
                pair_loss.append(-np.log(pairs[i][pair] + alone[i] * (ones + 1)[code]))
                word_loss.append(np.log(ones + WEIGHT)[code])
            del pair, code, pairs
            upto = 0
            for row in range(len(sent)):
                piece, bucket = sent["piece"][row].as_py(), sent["bucket"][row].as_py()
                docs, n, last, held = (np.frombuffer(sent[name][row].as_buffer(), kind) for name, kind in (("docs", np.int32), ("n", np.int32), ("last", np.uint8), ("doc", np.uint8)))
                doc = held.view(np.uint16 if len(held) == 2 * len(n) else np.uint32)
                x = slice(upto, upto + len(docs))
                upto += len(docs)
                touched, of = np.unique(doc, return_inverse=True)
                # a token's own count is the divisor of the bigram after it, which the last one has not
                sums = [np.bincount(of, n * np.repeat(p[x], docs) + (n - last.astype(np.int32)) * np.repeat(w[x], docs)) for p, w in zip(pair_loss, word_loss, strict=True)]
                for name, value in (("piece", piece), ("bucket", bucket), ("doc", touched.astype(np.int32).tobytes()), ("target", sums[0].tobytes()), ("background", sums[1].tobytes()), ("ids", None), ("tokens", None)):
                    out[name].append(value)
        for piece, ids, tokens in zip(*(records[x].to_pylist() for x in ("piece", "ids", "tokens")), strict=True):
            for name, value in (("piece", piece), ("bucket", -1), ("doc", None), ("target", None), ("background", None), ("ids", ids), ("tokens", tokens)):
                out[name].append(value)
        return pa.Table.from_pydict(out, schema=weighed)

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")  # sums in one order
        record = table.slice(0, 1)
        ids, n = (record[x].combine_chunks().flatten() for x in ("ids", "tokens"))
        n = n.to_numpy()
        sums = np.zeros((2, len(n)))
        for doc, *found in zip(*(table[x].to_pylist()[1:] for x in ("doc", "target", "background")), strict=True):
            for i, x in enumerate(found):
                sums[i, np.frombuffer(doc, np.int32)] += np.frombuffer(x)
        target, background = ((x + f) / np.maximum(n, 1) for x, f in zip(sums, first_loss, strict=True))
        none = n == 0
        return pa.table([ids, pa.array(n, pa.int64()), *(pa.array(x, pa.float64(), mask=none) for x in (target, background, target - background))], names=["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    sent = bigrams(rows, known, frequent.value[0], buckets).unionByName(target_bigrams(targets, known, frequent.value[0], buckets))
    sums = sent.groupBy("bucket").applyInArrow(weigh, "piece bigint, bucket bigint, doc binary, target binary, background binary, ids array<bigint>, tokens array<bigint>")
    return sums.groupBy("piece").applyInArrow(gather, "doc_id bigint, n_tokens bigint, loss_target double, loss_background double, score double")


def likely_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is among the ids, and some others: those that a filter of a fixed size can't tell from them."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = ids.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at"))
    bits = bits.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    held = rows.withColumns({"part": F.bitmap_bucket_number(place), "at": F.bitmap_bit_position(place)}).join(F.broadcast(bits), "part")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.where(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1).select(*rows.columns)


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """Scores of all documents; targets has the doc_id of each document that the target model learns from.

    words: the vocabulary is at most so many of the most frequent words; None takes all.
    docs is read several times, so it should be a table (files, or a written one), whose
    parts hold the same rows each time.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    known = None
    if words is not None:
        held = pa.array(frequent_words(rows.select("text"), words), pa.string())
        known = np.array([hash_words(split_words(held.slice(i, 1), ALNUM))[0] for i in range(len(held))], np.uint64)
    chosen = targets.select(F.col(doc_id).cast("bigint").alias("doc_id")).distinct()
    # one plan at every size: the number of targets has no bound, so their ids are never broadcast
    learnt = likely_rows(rows, chosen).join(chosen.hint("merge"), "doc_id", "left_semi").select("text")
    return score(rows, written(learnt, "targets"), known)
