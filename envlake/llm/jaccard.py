"""N-gram Jaccard join: which texts share nearly all their word shingles.

Set-relation skipping, in two places:

* Index lists by position. A set's hashed shingles, in order, fall into blocks by
  their position in the hash range. Two sets that link differ in at most d
  shingles, so with more than d blocks at least one block is the same in both.
  The index has a list for each (group of sizes, block position, content); a set
  looks up its own lists and skips every other, whatever frequent shingles the
  texts share. Blocks hold about six shingles, so a shared passage or a common
  phrase does not make a list.
* Answers from answers. Every link is found by them: inside a task, the overlaps of
  a set with all others are derived from those of the most similar set that has been
  answered, by the few shingles in which the two differ, and read from lists by
  skipping to the sets that come after it. First the members of a list meet its first
  one, in blocks; a group of near copies of one text is connected by then, for about
  as many shingles as its members differ in. Lists whose members are all connected are
  skipped from then on. Of what is left apart, parities of the sets, a few bits a
  shingle, tell which members of a list can't link, and the rest is answered alike.

Exact copies are one set from the start. Groups that are left apart, of any size,
are split into blocks, and every pair of blocks is one task's work, so none is
gathered whole. Hash collisions aside (64 bits a shingle), results are exact.

Defined results: a null or empty text has no shingles and links with nothing; a
repeated row is the same document, and so are rows with one id and different texts;
rows with a null doc_id link with nothing and get a null component; ties do not
occur, as a component is named by its smallest id; other columns, whatever their
names, play no part. A task holds a long text's words and shingles whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .lm import gathered
from .store import small_batches, written
from .text import BLACK, grams, hash_words, mix, pieces, split_words

#: Answered sets of which the most similar one gives a set's answers.
ANSWERED = 8
#: Sets, and shingles, in a block of a group that is compared in one task with another block.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 18
#: Shingles for each bucket of index lists, about; it has fewer lists than that.
BUCKET = 1 << 22


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles; with fewer words, of the whole sequence."""
    for a, b in pieces(texts):
        words = split_words(texts.slice(a, b - a), BLACK)
        hashes = hash_words(words)
        for i, j in zip(words.first[:-1], words.first[1:], strict=True):
            yield np.unique(grams(hashes[i:j], min(k, j - i))) if j > i else hashes[:0]


_GROUPS: dict[tuple[int, int], tuple[tuple[int, int, int], ...]] = {}


def size_groups(n: int, percent: int) -> tuple[tuple[int, int, int], ...]:
    """(group, blocks, empty blocks allowed) of each group of sizes that a set of n shingles belongs to.

    Bands of sizes grow by a half. Group g has band g and, above it, the sizes that
    can still link with it, so that two sets that link share a group.
    """
    if (n, percent) in _GROUPS:
        return _GROUPS[n, percent]
    found, low, g = [], 1, 0
    while low <= n:
        high = max(low, int(low * 1.5) - 1)
        top = high * 100 // percent
        if n <= top:
            differ = (high + top) * (100 - percent) // (100 + percent)
            spare = 0
            if differ > 4:
                mean = (differ + 1) * exp(-low / (differ + 1))
                spare = ceil(mean + 3 * sqrt(mean))
            found.append((g, differ + 1 + spare, spare))
        low, g = high + 1, g + 1
    _GROUPS[n, percent] = tuple(found)
    return _GROUPS[n, percent]


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """A key for each index list that the set belongs to.

    With one block more than can differ, and s more again, sets that link have
    s + 1 equal blocks. Empty blocks make no list, unless a set has more than s
    of them; such sets meet in a list of their own.
    """
    out, mixed = [], mix(hashes)
    for group, blocks, spare in size_groups(len(hashes), percent):
        block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        place = (np.uint64(group + 1) << np.uint64(40)) + block[first]
        out.append(mix(np.add.reduceat(mixed, first) ^ mix(place)))
        if blocks - len(first) > spare:
            out.append(mix(np.array([(group + 1) << 40 | 1 << 39], np.uint64)))
    return np.concatenate(out)


def _prepared(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, bits) of each row: its set's size, 128-bit digest and parities."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("bits", pa.binary())])

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = np.uint64(0xA0761D6478BD642F)
        for batch in batches:
            held = [(len(h), digest(h), digest(h ^ other), parities(h)) for h in shingle_sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in held], schema.types[i + 1]) for i in range(4))], schema=schema)

    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(prepare, "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, bits binary")


def digest(hashes: np.ndarray) -> int:
    """One number for a set, whatever its order."""
    return int(mix(hashes).sum(dtype=np.uint64).astype(np.int64))


def _members(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """(list, fp1): the sets of each index list that has several, from a table whose one column is text.

    A list has a bucket and a number of 40 bits there. A piece of texts sends each
    bucket the lists that it has there, set by set, and of its own sets in one list
    only the first; the others are known to be members without being sent there.
    """
    schema = pa.schema([("bucket", pa.int64()), ("known", pa.bool_()), ("lists", pa.binary()), ("sets", pa.binary()), ("runs", pa.binary())])
    low = np.uint64((1 << 40) - 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in gathered(batches, 0):
            own: dict[int, np.ndarray] = {}
            for h in shingle_sets(batch.column(0), k):
                name = digest(h)
                if len(h) and name not in own:
                    key = signatures(h, percent)
                    own[name] = ((key >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | key & low
            if not own:
                continue
            turn += 1
            names, places = np.array(list(own), np.int64), np.concatenate(list(own.values()))
            of = np.repeat(np.arange(len(own)), [len(x) for x in own.values()])
            order = np.lexsort((of, places))
            places, of = places[order], of[order]
            new = np.concatenate([[True], places[1:] != places[:-1]])
            at = np.flatnonzero(new)
            known = np.repeat(np.diff(np.append(at, len(places))) > 1, np.diff(np.append(at, len(places))))
            rows = [(turn % buckets, True, places[known].tobytes(), names[of[known]].tobytes(), None)] if known.any() else []
            places, of = places[at], of[at]
            order = np.lexsort((places, of, places >> np.uint64(40)))
            places, of = places[order], of[order]
            cuts = np.searchsorted(places >> np.uint64(40), np.arange(buckets + 1, dtype=np.uint64))
            for bucket in np.flatnonzero(np.diff(cuts)):
                x = slice(cuts[bucket], cuts[bucket + 1])
                held, runs = np.unique(of[x], return_counts=True)
                number = (places[x] & low).view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((int(bucket), False, number.tobytes(), names[held].tobytes(), runs.astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def find(table: pa.Table) -> pa.Table:
        places, names, met, them = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for bucket, known, lists, sets, runs in zip(*(table[x] for x in schema.names), strict=True):
            held = np.frombuffer(sets.as_buffer(), np.int64)
            if known.as_py():
                places.append(np.frombuffer(lists.as_buffer(), np.int64))
                names.append(held)
                continue
            five = np.frombuffer(lists.as_buffer(), np.uint8).reshape(-1, 5)
            number = np.zeros((len(five), 8), np.uint8)
            number[:, :5] = five
            met.append(number.reshape(-1).view(np.int64) | bucket.as_py() << 40)
            them.append(np.repeat(held, np.frombuffer(runs.as_buffer(), np.int32)))
        if met:
            place, name = np.concatenate(met), np.concatenate(them)
            order = np.lexsort((name, place))
            place, name = place[order], name[order]
            at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            ends = np.append(at[1:], len(place))
            several = np.repeat(name[at] != name[ends - 1], ends - at)
            several &= np.concatenate([[True], (place[1:] != place[:-1]) | (name[1:] != name[:-1])])
            places.append(place[several])
            names.append(name[several])
        return pa.table([pa.array(np.concatenate(x)) for x in (places, names)], names=["list", "fp1"])

    sent = docs.mapInArrow(ask, "bucket bigint, known boolean, lists binary, sets binary, runs binary")
    return sent.groupBy("bucket").applyInArrow(find, "list bigint, fp1 bigint").distinct()


class Answers:
    """Overlaps of sets with all larger ones, each set's from those of the most similar set that was answered before it.

    Sets are ordered by size, and the index has a list for each shingle with the places
    of the sets that hold it. A set's answer is another's, less the lists of the shingles
    that it lacks and plus those of the ones that it has besides; lists are entered at
    the set's own place, so that smaller sets are skipped. read counts the places that
    were read, derived the sets answered from others, counted those answered alone.
    """

    def __init__(self, sets: list[np.ndarray]):
        """sets: sorted hashes, the smallest set first."""
        self.size = np.array([len(s) for s in sets], np.int64)
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(self.size)])
        self.own = [np.sort(code[ends[i] : ends[i + 1]]) for i in range(len(sets))]
        # one array for all lists, in which a place is found by skipping
        self.places = np.sort(code.astype(np.int64) * len(sets) + np.repeat(np.arange(len(sets)), self.size))
        self.known: list[tuple[int, np.ndarray]] = []
        self.read = self.derived = self.counted = 0

    def _count(self, shingles: np.ndarray, first: int) -> np.ndarray:
        """How many of the shingles each set from the first on holds."""
        n = len(self.size)
        begin, end = np.searchsorted(self.places, shingles * n + first), np.searchsorted(self.places, (shingles + 1) * n)
        lengths = end - begin
        self.read += int(lengths.sum())
        at = np.repeat(begin - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        return np.bincount(self.places[at] % n, minlength=n)

    def of(self, i: int) -> np.ndarray:
        """The overlap of set i with each set from i on."""
        apart = lambda known: self.size[known[0]] + self.size[i] - 2 * known[1][i]
        near = min(self.known, key=apart, default=None)
        if near is not None and apart(near) < self.size[i]:
            old, new = self.own[near[0]], self.own[i]
            overlap = near[1] + self._count(np.setdiff1d(new, old, assume_unique=True), i) - self._count(np.setdiff1d(old, new, assume_unique=True), i)
            self.derived += 1
        else:
            overlap = self._count(self.own[i], i)
            self.counted += 1
        self.known = [*self.known[1 - ANSWERED :], (i, overlap)]
        return overlap


def local_components(ids: list[int], sets: list[np.ndarray], percent: int, labels: list[int] | None = None, answers: type[Answers] = Answers) -> list[tuple[int, int]]:
    """(id, smallest id that it reaches among these sets), for ids that reach a smaller one; sets with one label are connected already."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, n = np.array(ids, np.int64)[order], len(sets)
    found = answers([sets[i] for i in order])
    size = found.size
    label = np.arange(n) if labels is None else np.unique(np.array(labels, np.int64)[order], return_inverse=True)[1]
    upto = np.searchsorted(size, size * 100 // percent, side="right")
    for i in range(n - 1):
        a, b = i + 1, upto[i]
        if a >= b or (label[a:b] == label[i]).all():
            continue
        both = found.of(i)[a:b]
        for other in np.unique(label[a:b][100 * both >= percent * (size[i] + size[a:b] - both)]):
            low, high = min(label[i], other), max(label[i], other)
            label[label == high] = low
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return [(int(x), int(y)) for x, y in zip(ids, least[label], strict=True) if x != y]


def _shingles(docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles array<bigint>) of (node, text) rows, each set of a node once."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1), 1 << 20):
                held = list(shingle_sets(batch.column(1).slice(a, b - a), k))
                ends = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int32)
                digests = [digest(h) for h in held]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(digests, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held).astype(np.int64)))], schema=schema)

    found = docs.select("node", "text").mapInArrow(sets, "node bigint, digest bigint, shingles array<bigint>")
    return found.groupBy("node", "digest").agg(F.first("shingles").alias("shingles")).select("node", "shingles")


def _first_pairs(members: DataFrame) -> DataFrame:
    """(a, b): the first member of a list with each of its others."""
    first = members.groupBy("list").agg(F.min("rep").alias("first"))
    return members.join(first, "list").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect all that link of each first member a with its others, and more of them that do.

    pairs: (a, b, n), with b's size. The sets of a star are a task's work: its first
    member is answered, and the answers of the others are derived from it and from one
    another. Stars are dealt into as many blocks as the largest needs, each block with
    the first member; small blocks share tasks.
    """
    stars = pairs.groupBy("a").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    m, s, work = stars.agg(F.max("m"), F.max("s"), F.sum("s")).first()
    blocks = max(1, ceil((m or 0) / BLOCK_SETS), ceil((s or 0) / BLOCK_SHINGLES))
    dealt = pairs.select("a", F.col("b").alias("node"), F.pmod(F.xxhash64("b"), F.lit(blocks)).alias("block"))
    first = dealt.select("a", F.col("a").alias("node"), "block").distinct()
    place = F.xxhash64("a", "block")
    parts = 1 + (work or 0) // BLOCK_SHINGLES
    rows = dealt.unionByName(first).select(F.pmod(place, F.lit(parts)).alias("part"), place.alias("place"), "node").join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("node", "ascending")])
        place, nodes = table["place"].to_numpy(), table["node"].to_numpy()
        sets = [x.values.to_numpy().view(np.uint64) for x in table["shingles"]]
        cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
        pairs = [p for a, b in zip(cuts[:-1], cuts[1:], strict=True) for p in local_components(nodes[a:b].tolist(), sets[a:b], percent)]
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.groupBy("part").applyInArrow(compare, "a bigint, b bigint").distinct()


def _apart(members: DataFrame, components: DataFrame) -> DataFrame:
    """(list, rep, component): the members of lists that are not yet one component."""
    now = members.join(components, F.col("rep") == F.col("node"), "left").select("list", "rep", F.coalesce("component", "rep").alias("component"))
    spread = now.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return now.join(spread.select("list"), "list", "left_semi")


def parities(hashes: np.ndarray) -> bytes:
    """Bits, at least two for each shingle, of which each shingle turns one: those of two sets differ in no more bits than the sets in shingles."""
    bits = np.zeros(max(64, 1 << int(2 * len(hashes) - 1).bit_length()), np.uint8)
    places, n = np.unique(mix(hashes ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(len(bits)), return_counts=True)
    bits[places.astype(np.int64)] = n & 1
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The parities for fewer bits."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def may_link(sizes: np.ndarray, bits: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all sets of which any two can't be told to be no link by their parities."""
    found, label = [], np.arange(len(sizes))
    shortest = min(len(b) for b in bits)
    table = np.stack([_folded(b, shortest) for b in bits])
    for i in range(len(sizes) - 1):
        rest = np.flatnonzero((label != label[i]) & (np.arange(len(sizes)) > i))
        most = (sizes[rest] + sizes[i]) * (100 - percent) / (100 + percent)
        rest = rest[(np.bitwise_count(table[rest] ^ table[i]).sum(axis=1, dtype=np.int64) <= most) & (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))]
        for j in rest:
            if label[j] == label[i]:
                continue
            size = min(len(bits[i]), len(bits[j]))
            if size > shortest and np.bitwise_count(_folded(bits[i], size) ^ _folded(bits[j], size)).sum(dtype=np.int64) > (sizes[i] + sizes[j]) * (100 - percent) / (100 + percent):
                continue
            found.append((i, int(j)))
            label[label == label[j]] = label[i]
    return found


def _may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of nodes that can't be told to be no link by their parities, with the size of b."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.stack([batch.column(i).to_numpy() for i in (2, 4)], axis=1)
            bits = [[np.frombuffer(x, np.uint8) for x in batch.column(i).to_pylist()] for i in (3, 5)]
            kept = [bool(may_link(own, [x, y], percent)) for own, x, y in zip(n, *bits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(kept, pa.bool_())) for i in (0, 1, 4)], names=["a", "b", "n"])

    held = pairs.join(sketches.toDF("b", "m", "y"), "b").join(sketches.toDF("a", "n", "x"), "a")
    return held.select("a", "b", "n", "x", "m", "y").mapInArrow(keep, "a bigint, b bigint, n bigint").distinct()


def _near_pairs(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that connect the members of a list that may link; a list of any size is compared a block pair at a time."""
    sizes = members.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    rows = members.join(sizes, "list").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("own")) | (F.col("blocks") == 1))
    rows = rows.select("list", "rep", "own", F.explode(others).alias("other"))
    place = F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other"))
    # a list of m blocks has as many pairs of blocks, so the work to deal out is theirs, not the members'
    rows_sent = sizes.agg(F.sum(F.col("blocks").cast("bigint") * F.greatest(F.col("blocks") - 1, F.lit(1)))).first()[0] or 0
    groups = 1 + rows_sent // 8
    rows = rows.join(sketches.toDF("rep", "n", "bits"), "rep").select(F.pmod(place, F.lit(groups)).alias("part"), place.alias("place"), "rep", "n", "bits")

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("rep", "ascending")])
        place, rep, n = (table[x].to_numpy() for x in ("place", "rep", "n"))
        bits = [np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()]
        cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
        pairs = [(rep[a + i], rep[a + j]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1 for i, j in may_link(n[a:b], bits[a:b], percent)]
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.groupBy("part").applyInArrow(find, "a bigint, b bigint").where("a <> b").distinct()


def _all_links(members: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect all members of lists that link, every two of a group of sets that may link compared in one block pair."""
    nodes = groups.join(members.select(F.col("rep").alias("node"), "component").distinct(), "node")
    sized = nodes.join(sets.select("node", F.size("shingles").alias("n")), "node").groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    nodes = nodes.join(sized.select("cluster", blocks.alias("blocks")), "cluster")
    held = nodes.join(sets, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("own")) | (F.col("blocks") == 1))
    held = held.select("node", "component", "cluster", "shingles", "own", F.explode(others).alias("other"))
    held = held.select("node", "component", "cluster", "shingles", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        sets = [x.values.to_numpy().view(np.uint64) for x in table["shingles"]]
        pairs = local_components(table["node"].to_pylist(), sets, percent, table["component"].to_pylist())
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return held.groupBy("cluster", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: texts link when 100 * intersection >= percent * union."""
    table = written(_prepared(docs, k, doc_id, text), "sets")
    filled = table.where("n_shingles > 0 and doc_id is not null")
    copies = ["fp1", "fp2", "n_shingles"]
    reps = written(filled.groupBy(*copies).agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits")), "reps", narrow=True)
    # lists go by the digests of sets, so that neither they nor texts meet the rows before a list is known to have several members
    shingles = filled.agg(F.sum("n_shingles")).first()[0] or 0
    found = _members(docs.where(F.col(doc_id).isNotNull()).select(F.col(text).alias("text")), k, percent, 1 + shingles // BUCKET)
    members = found.join(reps.select("fp1", "rep"), "fp1").select("list", "rep")
    members = written(members, "members", narrow=True)
    # parities, a thirtieth of the shingles, tell which texts need their shingles compared
    sketches = written(reps.join(members.select("rep").distinct(), "rep").select("rep", "n_shingles", "bits"), "sketches", narrow=True)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("node"), F.col(text).alias("text"))
    first = written(_may_link(_first_pairs(members), sketches, percent), "pairs", narrow=True)
    nodes = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    sets = written(_shingles(texts.join(nodes, "node"), k), "shingles")
    components = written(connected(_linked(first, sets, percent)), "components")
    apart = written(_apart(members, components), "apart", narrow=True)
    if not apart.isEmpty():
        groups = written(connected(_near_pairs(apart, sketches, percent)).withColumnRenamed("component", "cluster"), "clusters")
        sets = written(_shingles(texts.join(groups.select("node"), "node"), k), "shingles")
        components = connected(components.toDF("a", "b").union(_all_links(apart, groups, sets, percent)))
    least = reps.join(components, F.col("rep") == F.col("node"), "left")
    # written, so that the join below has a shuffle on either side and Spark can split a set with very many copies
    least = written(least.select(*copies, F.coalesce("component", "rep").alias("found")), "components")
    joined = table.select("doc_id", *copies).join(least, copies, "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
