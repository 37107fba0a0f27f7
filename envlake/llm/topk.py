"""Exact top-k search by inner product with a dual tree of cover trees.

With centres q and p and covering radii s and r, no pair of two nodes scores more
than q.p + |q| r + |p| s + r s, and none less than q.p - |q| r - |p| s - r s. A pair of
nodes is left out when the first is less than what the query node's worst kth score is
known to be.

The upper levels of the tree are made by Spark: a node with more rows than a block
holds is split around pivots that are far apart in a sample of it, inside tasks, until
every node is a block, so the tree grows with the rows. A query lies in the nodes of
its own row. Pairs of a query node and a data node go down level by level; on each,
the second bound over nodes with more than k rows gives a query node's least kth score,
and the first leaves out pairs. Each query block is then compared with its nearest data
block, and after that with the blocks that its exact worst kth score leaves. A data
block is sent once for about as many queries as a query block has, of however many query
blocks they are. A task indexes both sides further, in cover trees, and prunes alike,
from the second time on with the kth scores that queries have reached. What is left is
compared whole, and Spark keeps the k best.

Of equal vectors only those with the k + 1 smallest ids can be among the k best, as
ties go to smaller ids, and equal queries are answered once. Nodes of one vector, or
that pivots don't split, are dealt into blocks by hash.

Defined results: vectors that are null, hold null or a component that is not
finite, or have no id take no part; vectors of different lengths don't meet; a
repeated row is one vector; different vectors with one id are one answer, with
the best score of any of them (for a query id too); a query that has fewer than k others gets them all;
a score beyond 64 bits is shown as the nearest one within.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

VECTOR = "key string, vec_id bigint, q array<bigint>, asked boolean"

#: Vectors in a data block and queries in a query block, at most about.
DATA_BLOCK, QUERY_BLOCK = 4096, 1024
#: Pivots of a node, at most, and the rows they are chosen from, about; rows that a task deals to pivots.
MOST_CELLS, SAMPLE, ROUTE_BLOCK = 64, 2048, 16_384
#: A node with more than this share of its parent's rows is not split again.
STUCK = 0.9
#: Points in a leaf, and a child's covering radius as a share of its parent's.
LEAF, SHRINK = 96, 0.7
#: Points of the most promising leaves that a query leaf is compared with before the others are pruned.
AT_FIRST = 512


def quantised(vectors: DataFrame, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, q array<bigint>): floor(scale * x) of each component x, where all are finite."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    q = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    return vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & ~bad).select(F.col(vec_id).cast("bigint").alias("vec_id"), q.alias("q"))


class Tree:
    """A cover tree: every node has a centre that is one of its points and a radius within which all of them lie.

    Points are reordered so that a node's are the rows from first to last. The
    centres of a node's children are further apart than the children's radius. A node
    whose children would have a few points each, as in data without clusters, is a leaf.
    """

    def __init__(self, points: np.ndarray):
        """points: one at least."""
        self.order = np.arange(len(points))
        self.first, self.last, self.radius, self.centre, self.children = [], [], [], [], []
        self._points = points
        todo = [(self._node(self.order, points[0]), self.order)]
        placed = []
        while todo:
            node, members = todo.pop()
            if len(members) <= LEAF or self.radius[node] == 0:
                placed.append((node, members))
                continue
            limit = self.radius[node] * SHRINK
            rest, near = members, self._distances(members, self.centre[node])
            parts = []
            while len(rest) and len(parts) * (LEAF // 8) <= len(members):
                centre = points[rest[np.argmin(near)]] if not parts else points[rest[np.argmax(near)]]
                d = self._distances(rest, centre)
                parts.append((centre, rest[d <= limit]))
                rest, near = rest[d > limit], near[d > limit]
            if len(rest) or len(parts) * (LEAF // 8) > len(members):
                placed.append((node, members))
                continue
            for centre, own in parts:
                child = self._node(own, centre)
                self.children[node].append(child)
                todo.append((child, own))
        # lay the leaves out one after the other, then let parents span their children
        at, leaves = 0, dict(placed)
        order = []
        stack = [(0, False)]
        while stack:
            node, done = stack.pop()
            if node in leaves:
                self.first[node] = at
                at += len(leaves[node])
                self.last[node] = at
                order.append(leaves[node])
            elif done:
                self.first[node] = min(self.first[c] for c in self.children[node])
                self.last[node] = max(self.last[c] for c in self.children[node])
            else:
                stack.append((node, True))
                stack += [(c, False) for c in reversed(self.children[node])]
        self.order = np.concatenate(order)
        self.centre = np.array(self.centre)
        self.length = np.sqrt((self.centre**2).sum(axis=1))
        self.radius = np.array(self.radius)

    def _distances(self, members: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(((self._points[members] - centre) ** 2).sum(axis=1))

    def _node(self, members: np.ndarray, centre: np.ndarray) -> int:
        self.first.append(0)
        self.last.append(0)
        self.centre.append(centre)
        self.children.append([])
        self.radius.append(float(self._distances(members, centre).max()))
        return len(self.radius) - 1


def dual_search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int, others: bool = True, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best other ids (or of all ids), ties to the smaller id; least: what each query's scores must reach."""
    top = max(int(abs(x)) for a in (queries, points) for x in (a.max(initial=1), a.min(initial=-1))) ** 2 * max(queries.shape[1], 1)
    kind = np.float64 if top < 2**52 else object
    qt, pt = Tree(queries.astype(float)), Tree(points.astype(float))
    query_ids, ids = query_ids[qt.order], ids[pt.order]
    q, p = queries[qt.order].astype(kind), points[pt.order].astype(kind)
    best = np.full((len(q), k), -np.inf, kind)
    if least is not None:
        best[:] = least[qt.order][:, None]
    single = kind is np.float64 and len(np.unique(ids)) == len(ids)
    kept: list[list[tuple]] = [[] for _ in range(len(q))]
    slack = 1e-9 * float(top) + 1e-6
    below = [np.array(c, np.int64) for c in pt.children]
    inner = np.array([len(c) > 0 for c in below])
    first, last = np.array(pt.first), np.array(pt.last)

    def unpruned(a: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the data nodes that may hold an answer of a query in node a, and the most they can score."""
        most = pt.centre[nodes] @ qt.centre[a] + qt.length[a] * pt.radius[nodes] + (pt.length[nodes] + pt.radius[nodes]) * qt.radius[a] + slack
        able = most >= best[qt.first[a] : qt.last[a], -1].min()
        return nodes[able], most[able]

    def compare(a: int, leaves: np.ndarray) -> None:
        rows = np.concatenate([np.arange(first[n], last[n]) for n in leaves])
        held = p[rows].T
        for start in range(qt.first[a], qt.last[a], LEAF):
            x = slice(start, min(start + LEAF, qt.last[a]))
            score = q[x] @ held
            able = score >= best[x, -1:]
            if others:
                able &= query_ids[x][:, None] != ids[rows][None, :]
            for row in np.flatnonzero(able.any(axis=1)):
                i, at = x.start + row, np.flatnonzero(able[row])
                if len(at) > k:
                    if single:  # sort but the k best and their ties
                        own = score[row, at]
                        at = at[own >= np.partition(own, len(own) - k)[len(own) - k]]
                    at = at[np.lexsort((ids[rows[at]], -score[row, at]))]
                    at = at[np.sort(np.unique(ids[rows[at]], return_index=True)[1])[:k]]
                once: dict = {}  # an id takes one place, with its best score
                for s, j in sorted(kept[i] + [(-score[row, j], ids[rows[j]]) for j in at]):
                    once.setdefault(j, s)
                kept[i] = [(s, j) for j, s in once.items()][:k]
                best[i, : len(kept[i])] = [-s for s, _ in kept[i]]

    todo = [(0, np.array([0]))]
    while todo:
        a, nodes = todo.pop()
        nodes, most = unpruned(a, nodes)
        wide = inner[nodes] & ((pt.radius[nodes] >= qt.radius[a]) | (not qt.children[a]))
        if wide.any():
            todo.append((a, np.concatenate([nodes[~wide], *(below[n] for n in nodes[wide])])))
        elif qt.children[a]:
            todo += [(c, nodes) for c in qt.children[a]]
        elif len(nodes):
            nodes = nodes[np.argsort(-most, kind="stable")]
            near = 1 + int(np.searchsorted(np.cumsum(last[nodes] - first[nodes]), AT_FIRST))
            compare(a, nodes[:near])
            rest, _ = unpruned(a, nodes[near:])
            if len(rest):
                compare(a, rest)
    found = [(query_ids[i], j, min(max(int(-s), -(2**63)), 2**63 - 1)) for i, own in enumerate(kept) for s, j in own]
    return tuple(np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ())))


def pivots(points: np.ndarray, most: int) -> np.ndarray:
    """Up to most of the points far apart from one another, each the farthest from those before it."""
    points = points[np.lexsort(points.T[::-1])].astype(np.float64)  # the same whatever order rows come in
    chosen = [points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin()]]
    near = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < most and near.max() > 0:
        chosen.append(points[near.argmax()])
        near = np.minimum(near, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _matrix(column: pa.ChunkedArray | pa.Array, kind=np.int64) -> np.ndarray:
    """The vectors of one length as rows."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks if len(c)]
    whole = np.concatenate(flat).astype(kind) if flat else np.zeros(0, kind)
    return whole.reshape(len(column), len(whole) // max(len(column), 1))


def _fit(sample: pa.Table) -> pa.Table:
    """A row for each pivot of a node: its child's name and centre."""
    node, n = sample["node"][0].as_py(), sample["n"][0].as_py()
    centres = pivots(_matrix(sample["q"]), int(min(MOST_CELLS, max(2, -(-n // DATA_BLOCK)))))
    ends = pa.array(np.arange(len(centres) + 1, dtype=np.int32) * centres.shape[1])
    return pa.table({"node": [node] * len(centres), "n": [n] * len(centres), "child": [f"{node}/{i}" for i in range(len(centres))], "centre": pa.ListArray.from_arrays(ends, pa.array(centres.ravel()))})


def _assign(rows: pa.Table, models: pa.Table) -> pa.Table:
    """Every row with the child of its nearest pivot and the distance to it; without pivots (an empty sample) the whole node is one child."""
    child, far = pa.array([f"{x}/0" for x in rows["node"].to_pylist()], pa.string()), np.zeros(len(rows))
    q = _matrix(rows["q"], np.float64)
    if len(rows) and len(models):
        centres, name = _matrix(models["centre"], np.float64), models["child"].to_pylist()
        near, far = np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
        for i, c in enumerate(centres):
            d = np.sqrt(((q - c) ** 2).sum(axis=1))
            near, far = np.where(d < far, i, near), np.minimum(d, far)
        child = pa.array([name[i] for i in near], pa.string())
    elif len(rows):
        far = np.sqrt((q**2).sum(axis=1))
    return pa.table({"node": child, "far": far, **{c: rows[c] for c in ("key", "vec_id", "q", "asked")}})


def _bounded(batches):
    """(a, b, n, middle, low, most) of pairs of nodes, from both centres and radii."""
    for mixed in batches:
        dims = mixed.column("qa").value_lengths().to_numpy()
        for dim in np.unique(dims):
            batch = mixed.take(pa.array(np.flatnonzero(dims == dim)))
            q, p = (_matrix(batch.column(c), np.float64) for c in ("qa", "pb"))
            r, s = (batch.column(c).to_numpy() for c in ("r", "s"))
            middle = (q * p).sum(axis=1)
            lq, lp = np.sqrt((q * q).sum(axis=1)), np.sqrt((p * p).sum(axis=1))
            spread = lq * s + lp * r + r * s + 1e-9 * (lq + r) * (lp + s) + 1e-3
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("n"), *(pa.array(x) for x in (middle, middle - spread, middle + spread))], names=["a", "b", "n", "middle", "low", "most"])


def _blocks(count: Column, most: int) -> Column:
    return F.ceil(count / F.lit(most)).cast("int")


def _parts(count: Column) -> Column:
    """The data blocks of a leaf."""
    return _blocks(count, 2 * DATA_BLOCK)


def _block(of: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), of), blocks).cast("int")


class Cells:
    """The upper levels of the tree: `rows` (node, d, key, vec_id, q, asked) of leaves, d the data block, and `levels`, tables of nodes.

    A level has (node, parent, centre, n, s, n_q, r, wide, leaf): rows and queries and
    the radii that hold them, whether data go down to children, and whether it is a leaf.
    """

    def __init__(self, vectors: DataFrame):
        """vectors: (key, vec_id, q, asked)."""
        zero = F.array_repeat(F.lit(0.0), F.col("dim"))
        # lengths are summed up for queries alone: a root is met as data by itself only, so a wider radius prunes no less
        length = F.sqrt(F.aggregate("q", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
        most = F.sqrt(F.size("q")) * F.greatest(F.array_max("q").cast("double"), -F.array_min("q").cast("double"))
        rows = vectors.withColumn("node", F.concat(F.lit("d"), F.size("q").cast("string"))).withColumn("far", F.when(F.col("asked"), length).otherwise(F.coalesce(most, F.lit(0.0))))
        root = rows.groupBy("node").agg(*self._counts()).withColumns({"centre": zero, "parent": F.lit(None).cast("string")})
        self.levels, done = [written(self._shaped(root.withColumn("n_parent", F.lit(2**62))), "nodes")], []
        while True:
            wide = self.levels[-1].where("wide").select("node", "n")
            leaves = self.levels[-1].where("leaf").select("node", _parts(F.col("n")).alias("parts"))
            done.append(rows.join(leaves, "node").select("node", F.concat_ws("#", "node", _block("vec_id", F.col("parts"))).alias("d"), "key", "vec_id", "q", "asked"))
            if wide.isEmpty():
                break
            here = rows.join(wide, "node")
            sample = here.where(F.pmod(F.xxhash64(F.lit("pivot"), "vec_id", "key"), F.lit(2**32)) < F.lit(float(SAMPLE)) / F.col("n") * F.lit(float(2**32)))
            models = written(sample.groupBy("node", "n").applyInArrow(_fit, "node string, n bigint, child string, centre array<double>"), "pivots")
            blocks = wide.withColumn("block", F.explode(F.sequence(F.lit(0), _blocks(F.col("n"), ROUTE_BLOCK) - 1))).drop("n")
            dealt = models.join(blocks, "node").select("node", "block", "child", "centre")
            placed = here.withColumn("block", _block("vec_id", _blocks(F.col("n"), ROUTE_BLOCK))).select("node", "block", "key", "vec_id", "q", "asked")
            rows = written(placed.groupBy("node", "block").cogroup(dealt.groupBy("node", "block")).applyInArrow(_assign, f"node string, far double, {VECTOR}"), "cells")
            below = rows.groupBy("node").agg(*self._counts()).withColumn("parent", F.regexp_replace("node", "/[0-9]+$", ""))
            below = below.join(wide.toDF("parent", "n_parent"), "parent").join(models.select(F.col("child").alias("node"), "centre"), "node", "left")
            self.levels.append(written(self._shaped(below.withColumn("centre", F.coalesce(F.col("centre"), zero))), "nodes"))
        self.rows = reduce(DataFrame.unionByName, done)

    @staticmethod
    def _counts() -> list[Column]:
        asked = F.col("asked")
        return [F.count("*").alias("n"), F.max("far").alias("s"), F.count_if(asked).alias("n_q"), F.max(F.when(asked, F.col("far"))).alias("r"), F.max(F.size("q")).alias("dim")]

    @staticmethod
    def _shaped(nodes: DataFrame) -> DataFrame:
        wide = (F.col("n") > DATA_BLOCK) & (F.col("s") > 0) & (F.col("n") <= STUCK * F.col("n_parent"))
        return nodes.select("node", "parent", "centre", "n", "s", "n_q", "r", wide.alias("wide"), (~wide).alias("leaf"))

    def pairs(self, k: int, report: Callable[[int, int], None] | None = None) -> tuple[DataFrame, DataFrame]:
        """((a, b, n, middle, most) pairs of a query node and a leaf of the data that the bounds leave, (a, n_q) query nodes).

        report gets each level and the number of pairs of a query and a vector that it leaves.
        """
        root = self.levels[0]
        pairs = root.where("n_q > 0").select(F.col("node").alias("a"), F.col("node").alias("b"))
        for level, nodes in enumerate(self.levels):
            # both sides go down together: a node that is final on its side stays while the other goes on
            every = reduce(DataFrame.unionByName, self.levels[: level + 1])
            if level:
                up = self.levels[level - 1]
                split_a = up.where(F.col("wide") & (F.col("n_q") > QUERY_BLOCK)).select(F.col("node").alias("a"))
                split_b = up.where("wide").select(F.col("node").alias("b"))
                child = nodes.select("node", "parent", "n_q")
                a = pairs.join(split_a, "a", "left_semi").join(child.where("n_q > 0").select(F.col("parent").alias("a"), F.col("node").alias("to")), "a").select(F.col("to").alias("a"), "b")
                pairs = a.unionByName(pairs.join(split_a, "a", "left_anti"))
                b = pairs.join(split_b, "b", "left_semi").join(child.select(F.col("parent").alias("b"), F.col("node").alias("to")), "b").select("a", F.col("to").alias("b"))
                pairs = b.unionByName(pairs.join(split_b, "b", "left_anti"))
            left = pairs.join(every.select(F.col("node").alias("a"), F.col("centre").alias("qa"), "r"), "a")
            both = left.join(every.select(F.col("node").alias("b"), F.col("centre").alias("pb"), "s", "n"), "b")
            bounded = both.select("a", "b", "qa", "pb", "r", "s", "n").mapInArrow(_bounded, "a string, b string, n bigint, middle double, low double, most double")
            sure = Window.partitionBy("a").orderBy(F.desc("low"), "b")
            ranked = bounded.withColumn("sum", F.sum("n").over(sure.rowsBetween(Window.unboundedPreceding, 0)))
            least = F.max(F.when(F.col("sum") >= k, F.col("low"))).over(Window.partitionBy("a"))
            kept = ranked.withColumn("least", least).where(F.col("least").isNull() | (F.col("most") >= F.col("least")))
            found = written(kept.select("a", "b", "n", "middle", "most"), "pairs")
            if report:
                asked = every.select(F.col("node").alias("a"), "n_q")
                report(level, found.join(asked, "a").agg(F.coalesce(F.sum(F.col("n") * F.col("n_q")), F.lit(0))).first()[0])
            pairs = found.select("a", "b")
        nodes = reduce(DataFrame.unionByName, self.levels).select(F.col("node").alias("a"), "n_q")
        return found, nodes.join(found.select("a").distinct(), "a", "left_semi")


def search(vectors: DataFrame, is_query: Column, k: int = 5, report: Callable[[int, int], None] | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) from quantised (vec_id, q) rows: the k best others of each query row.

    report, if given, gets each level of the tree and how many pairs of a query and a vector it leaves.
    """
    key = F.concat(F.hex(F.xxhash64("q")), F.lit("-"), F.hex(F.xxhash64(F.lit("key"), "q")))
    once = vectors.select("vec_id", "q", F.coalesce(is_query, F.lit(False)).alias("query")).distinct()
    once = written(once.withColumn("key", key), "vectors")
    turn = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    queries = once.where("query").select(F.col("vec_id").alias("query_id"), "key").distinct()
    few = once.withColumn("turn", turn).where(F.col("turn") <= k + 1).select("key", "vec_id", "q", "turn")
    # a vector is asked for by the row of its smallest id; the join finds the rows dealt by key
    asked = once.where("query").select("key", F.lit(True).alias("_asked")).distinct()
    table = written(few.join(asked, "key", "left").select("key", "vec_id", "q", (F.col("_asked").isNotNull() & (F.col("turn") == 1)).alias("asked")), "entries")
    # an id with several vectors fills one of the k places, so more rows are needed to be sure of k + 1 ids
    versions = table.groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    cells = Cells(table)
    pairs, asking = cells.pairs((k + 1) * versions, report)
    data = written(cells.rows, "index")
    wanted = data.where("asked").select("key", "q", "node")
    path = F.split("node", "/")
    # a query block is a node or, where a node can't be split, a part of it
    ancestors = F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.array_join(F.slice(path, F.lit(1), i), "/"))
    met = wanted.withColumn("a", F.explode(ancestors)).join(asking, "a")
    met = written(met.withColumn("own", _block("key", _blocks(F.col("n_q"), QUERY_BLOCK))).select(F.concat_ws("#", "a", "own").alias("b"), "key", "q", "a"), "asked")
    rows = data.select("d", "vec_id", "q")
    pairs = pairs.withColumnRenamed("b", "leaf").join(met.groupBy("a", "b").agg(F.count("*").alias("n_b")), "a").withColumn("parts", _parts(F.col("n")))
    pairs = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = written(pairs.select("b", "n_b", F.concat_ws("#", "leaf", "part").alias("d"), F.floor(F.col("n") / F.col("parts")).alias("n_d"), "middle", "most"), "blocks")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 3
        if len(left) and len(right):
            least = np.array([-np.inf if x is None else x for x in left["least"].to_pylist()], object)
            found = dual_search(np.arange(len(left)), _matrix(left["q"]), right["vec_id"].to_numpy(), _matrix(right["q"]), k + 1, others=False, least=least)
        return pa.table({**{c: left[c].take(pa.array(found[0])) for c in ("b", "key")}, "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.int64())})

    def compared(chosen: DataFrame, asking: DataFrame) -> DataFrame:
        """The best of the pairs of blocks: a data block meets its queries by about QUERY_BLOCK at a time, however few each query block has."""
        before = F.sum("n_b").over(Window.partitionBy("d").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
        dealt = chosen.select("b", "d", F.floor(F.coalesce(before, F.lit(0)) / QUERY_BLOCK).alias("turn"))
        left = asking.join(dealt, "b").select("d", "turn", "b", "key", "q", "least")
        right = rows.join(dealt.select("d", F.col("turn").alias("turn")).distinct(), "d").select("d", "turn", "vec_id", "q")
        return left.groupBy("d", "turn").cogroup(right.groupBy("d", "turn")).applyInArrow(meet, "b string, key string, vec_id bigint, score bigint")

    home = pairs.withColumn("turn", F.row_number().over(Window.partitionBy("b").orderBy((F.col("n_d") <= k).cast("int"), F.desc("middle"), "d"))).where("turn = 1")
    first = written(compared(home, met.withColumn("least", F.lit(None).cast("bigint"))), "first")
    reached = first.groupBy("b", "key").agg(F.count_distinct("vec_id").alias("n"), F.min("score").alias("kth"))
    worst = reached.groupBy("b").agg(F.min("n").alias("n"), F.min("kth").alias("kth"), F.count("*").alias("found"))
    known = met.groupBy("b").agg(F.count("*").alias("rows")).join(worst, "b", "left")
    limit = F.when((F.col("n") >= k + 1) & (F.col("found") >= F.col("rows")), F.col("kth").cast("double")).otherwise(F.lit(float("-inf")))
    rest = pairs.join(home.select("b", "d"), ["b", "d"], "left_anti").join(known.select("b", limit.alias("least")), "b").where("most >= least")
    # a score that is shown as the least number may be any below it
    least = reached.where((F.col("n") >= k + 1) & (F.col("kth") > -(2**63))).select("b", "key", F.col("kth").alias("least"))
    near = first.unionByName(compared(rest, met.join(least, ["b", "key"], "left"))).groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    best = written(near.withColumn("place", place).where(F.col("place") <= k + 1).select("key", "vec_id", "score"), "best")
    answers = queries.join(best, "key").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
