"""Approximate nearest neighbours by cosine with learned partitions.

The rows of a node of the index are split by three steps, all in tasks and on a
bounded sample of the node: the graph of each sampled vector's nearest others; a
balanced partition of that graph with few edges between parts (spectral bisection,
then moves that save edges and keep sizes); and a small classifier, one hidden layer,
that learns from a vector in which parts its neighbours lie. The classifier sends
every row of the node to its most probable part, and parts that are still large are
split in the same way. A query follows all classifiers down: of the parts it meets it
takes the most probable ones until they hold `mass` of its neighbours by the
classifiers' estimate. All rows of those parts are compared with it exactly.

So a query meets few parts where neighbours lie together, and nearly all where vectors
have no structure; recall follows `mass` in either case.

Equal vectors are one entry with the smallest ids, k + 1 of them: no others can be
among the k best, as ties go to smaller ids. Equal queries are answered once. Parts
that can't be split, and parts that many queries meet, are compared in blocks.

Defined results: vectors that are null, all zeros, or hold null or a component that is
not finite, and rows without an id, take no part; vectors of different lengths don't
meet; a repeated row is one vector; different vectors with one id are one answer, with
the best score of any of them (for a query id too); a query with fewer than k others
gets them all; a part is taken beyond `mass` as long as fewer than k + 1 are held;
other columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Rows in a part, about; a node of up to twice as many is not split. Parts of a node, at most.
PART_ROWS, MOST_PARTS = 4096, 16
#: Rows of a node that its graph and classifier are fitted on, about; neighbours of each in the graph.
SAMPLE, NEIGHBOURS = 4096, 10
#: Entries and queries that a task compares at once, about; rows that it routes.
DATA_BLOCK, QUERY_BLOCK, ROUTE_BLOCK = 8192, 1024, 16_384
HIDDEN, STEPS, BATCH, RATE, DECAY = 64, 400, 512, 0.01, 1e-4
#: A part with more than this share of its node's rows is not split again.
STUCK = 0.9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows with length 1; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(points: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest others of each unit vector."""
    n = len(points)
    out = np.empty((n, min(k, n - 1)), np.int64)
    for at in range(0, n, 1024):
        near = points[at : at + 1024] @ points.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0, rounds: int = 30, slack: float = 1.05) -> np.ndarray:
    """The part of each vertex: parts of almost equal size with few edges between them."""
    rng, n = np.random.default_rng(seed), len(graph)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        members, low, high = todo.pop()
        part[members] = low
        if high - low == 1 or len(members) < 2:
            continue
        # a smooth vector over the members' graph, cut at its quantile
        m, place = len(members), np.full(n, -1)
        place[members] = np.arange(m)
        inside = (place[a] >= 0) & (place[b] >= 0)
        x, y = place[a[inside]], place[b[inside]]
        degree = np.maximum(np.bincount(x, minlength=m), 1)
        v = rng.normal(size=m)
        for _ in range(60):
            v = v + np.bincount(x, weights=v[y], minlength=m) / degree
            v -= (v * degree).sum() / degree.sum()
            v /= np.linalg.norm(v) + 1e-300
        middle = (low + high) // 2
        order, cut = np.argsort(v, kind="stable"), round(m * (middle - low) / (high - low))
        todo += [(members[order[:cut]], low, middle), (members[order[cut:]], middle, high)]
    most = int(np.ceil(n / parts * slack))
    for _ in range(rounds):
        edges = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        best = edges.argmax(axis=1)
        gain = edges[np.arange(n), best] - edges[np.arange(n), part]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[best[i]] < most and rng.random() < 0.5:  # half at a time, as neighbours move too
                size[best[i]] += 1
                size[part[i]] -= 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A classifier with one hidden layer: the probability that a vector's neighbours lie in each part."""

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = arrays

    @classmethod
    def fitted(cls, points: np.ndarray, shares: np.ndarray, seed: int = 0) -> Router:
        """From unit vectors and the share of each one's neighbours in each part."""
        rng = np.random.default_rng(seed)
        middle, scale = points.mean(axis=0), points.std(axis=0) + 1e-12
        x = (points - middle) / scale
        own = [rng.normal(size=(x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]) / 2, np.zeros(HIDDEN), rng.normal(size=(HIDDEN, shares.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(shares.shape[1])]
        first, second = [0 * w for w in own], [0 * w for w in own]
        for t in range(1, STEPS + 1):
            rows = rng.integers(0, len(x), min(BATCH, len(x)))
            h = np.maximum(x[rows] @ own[0] + own[1], 0)
            g = (_softmax(h @ own[2] + own[3]) - shares[rows]) / len(rows)
            back = (g @ own[2].T) * (h > 0)
            for i, d in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                d = d + DECAY * own[i]
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.999 * second[i] + 0.001 * d * d
                own[i] = own[i] - RATE * first[i] / (1 - 0.9**t) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
        return cls([middle, scale, *own])

    def probabilities(self, points: np.ndarray) -> np.ndarray:
        middle, scale, w, b, u, c = self.arrays
        return _softmax(np.maximum((points - middle) / scale @ w + b, 0) @ u + c)

    def pack(self) -> bytes:
        return np.concatenate([[len(self.arrays[0]), len(self.arrays[-1])], *[a.ravel() for a in self.arrays]]).astype(np.float64).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Router:
        flat = np.frombuffer(data, np.float64)
        dim, parts = int(flat[0]), int(flat[1])
        shapes = [(dim,), (dim,), (dim, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
        ends = np.cumsum([2, *[int(np.prod(s)) for s in shapes]])
        return cls([flat[ends[i] : ends[i + 1]].reshape(s) for i, s in enumerate(shapes)])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def learn(points: np.ndarray, parts: int) -> Router:
    """Graph, balanced partition and classifier of some unit vectors."""
    graph = neighbour_graph(points)
    part = balanced_parts(graph, parts)
    shares = np.zeros((len(points), parts))
    for column in graph.T:
        shares[np.arange(len(points)), part[column]] += 1
    shares[np.arange(len(points)), part] += graph.shape[1] / 4
    return Router.fitted(points, shares / shares.sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of one length as rows."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def entries(vectors: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(key, v, ids): every different vector once, with its k + 1 smallest ids."""
    x = F.col(embedding)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))) & F.exists(x, lambda c: c != 0)
    rows = vectors.where(F.col(vec_id).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(vec_id).cast("bigint").alias("id"), x.alias("v")).distinct()
    turn = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("turn", turn).where(F.col("turn") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(vector_key(F.col("v")).alias("key"), "v", "ids")


def vector_key(v: Column) -> Column:
    """128 bits that tell vectors apart."""
    return F.concat(F.hex(F.xxhash64(v)), F.lit("-"), F.hex(F.xxhash64(F.lit("key"), v)))


def _blocks(count: Column, most: int) -> Column:
    return F.ceil(count / F.lit(most)).cast("int")


def _block(of: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), of), blocks).cast("int")


class Index:
    """The parts of all entries: `rows` (node, key, v, ids), `sizes` (node, n, ids), and the classifiers by level."""

    def __init__(self, found: DataFrame):
        """found: entries()."""
        self.levels: list[tuple[DataFrame, DataFrame]] = []
        open_rows, done = found.withColumn("node", F.concat(F.lit("d"), F.size("v").cast("string"))), []
        sizes = written(open_rows.groupBy("node").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).withColumn("wide", F.col("n") > 2 * PART_ROWS), "sizes")
        self.roots = sizes
        while True:
            done.append(open_rows.join(sizes.where("not wide").select("node"), "node").select("node", "key", "v", "ids"))
            if sizes.where("wide").isEmpty():
                break
            wide = sizes.where("wide").select("node", "n")
            here = open_rows.join(wide, "node")
            sample = here.where(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(2**32)) < F.lit(float(SAMPLE)) / F.col("n") * F.lit(float(2**32)))
            models = written(sample.groupBy("node", "n").applyInArrow(_fit, "node string, n bigint, model binary"), "models")
            rows = here.withColumn("block", _block("key", _blocks(F.col("n"), ROUTE_BLOCK)))
            dealt = models.withColumn("block", F.explode(F.sequence(F.lit(0), _blocks(F.col("n"), ROUTE_BLOCK) - 1)))
            kind = f"node string, key string, v {dict(found.dtypes)['v']}, ids array<bigint>"
            open_rows = written(rows.select("node", "block", "key", "v", "ids").groupBy("node", "block").cogroup(dealt.groupBy("node", "block")).applyInArrow(_assign, kind), "routed")
            parent = F.regexp_replace("node", "/[0-9]+$", "")
            below = open_rows.groupBy("node").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).withColumn("parent", parent)
            below = below.join(wide.toDF("parent", "n_parent"), "parent")
            sizes = written(below.select("node", "n", "ids", ((F.col("n") > 2 * PART_ROWS) & (F.col("n") <= STUCK * F.col("n_parent"))).alias("wide")), "sizes")
            self.levels.append((models.select("node", "model"), sizes))
        self.rows = done[0]
        for more in done[1:]:
            self.rows = self.rows.unionByName(more)

    def route(self, asked: DataFrame, mass: float, least: int) -> DataFrame:
        """(key, v, node): the parts that each query (key, v) meets, from the top down."""
        each = mass ** (1 / max(1, len(self.levels)))
        at = asked.withColumn("node", F.concat(F.lit("d"), F.size("v").cast("string"))).withColumn("p", F.lit(1.0))
        kind = f"key string, v {dict(asked.dtypes)['v']}, node string, p double"
        sizes = self.roots
        done = at.join(sizes.where("not wide").select("node"), "node").select("key", "v", "node", "p")
        for models, below in self.levels:
            wide = at.join(sizes.where("wide").select("node", F.lit(True).alias("w")), "node", "left_semi")
            counted = written(wide.groupBy("node").agg(_blocks(F.count("*"), ROUTE_BLOCK).alias("blocks")), "met")
            rows = wide.join(counted, "node").withColumn("block", _block("key", F.col("blocks"))).select("node", "block", "key", "v", "p")
            dealt = models.join(counted, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("node", "block", "model")
            spread = rows.groupBy("node", "block").cogroup(dealt.groupBy("node", "block")).applyInArrow(_spread, kind)
            every = done.join(_all_sizes(self.roots, self.levels), "node").select("key", "v", "node", "p", "ids").withColumn("wide", F.lit(False)).unionByName(spread.join(below.select("node", "ids", "wide"), "node").select("key", "v", "node", "p", "ids", "wide"))
            before = Window.partitionBy("key").orderBy(F.desc("p"), "node").rowsBetween(Window.unboundedPreceding, -1)
            share = F.col("p") / F.sum("p").over(Window.partitionBy("key"))
            ranked = every.withColumn("share", share).withColumn("mass", F.coalesce(F.sum("share").over(before), F.lit(0.0))).withColumn("held", F.coalesce(F.sum("ids").over(before), F.lit(0)))
            kept = written(ranked.where((F.col("mass") < each) | (F.col("held") < least)).select("key", "v", "node", "p", "wide"), "kept")
            done, at, sizes = kept.where("not wide").drop("wide"), kept.where("wide").drop("wide"), below
        return done.select("key", "v", "node")


def _all_sizes(roots: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    found = roots
    for _, sizes in levels:
        found = found.unionByName(sizes)
    return found.where("not wide").select("node", "ids")


def _fit(sample: pa.Table) -> pa.Table:
    points, n = unit(_matrix(sample["v"])), sample["n"][0].as_py()
    order = np.argsort(sample["key"].to_numpy(zero_copy_only=False).astype(str), kind="stable")  # the same model whatever order rows come in
    parts = int(min(MOST_PARTS, max(2, -(-n // PART_ROWS))))
    model = learn(points[order], parts) if len(points) > 1 else Router([points[0], np.ones(points.shape[1]), np.zeros((points.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, parts)), np.zeros(parts)])
    return pa.table({"node": [sample["node"][0].as_py()], "n": [n], "model": [model.pack()]}, schema=pa.schema([("node", pa.string()), ("n", pa.int64()), ("model", pa.binary())]))


def _assign(rows: pa.Table, models: pa.Table) -> pa.Table:
    """Every row goes to its most probable part; without a model (an empty sample) to the first."""
    part = np.zeros(len(rows), np.int64)
    if len(rows) and len(models):
        part = Router.unpacked(models["model"][0].as_py()).probabilities(unit(_matrix(rows["v"]))).argmax(axis=1)
    nodes = pa.array([f"{a}/{p}" for a, p in zip(rows["node"].to_pylist(), part.tolist(), strict=True)], pa.string())
    return pa.table({"node": nodes, "key": rows["key"], "v": rows["v"], "ids": rows["ids"]})


def _spread(rows: pa.Table, models: pa.Table) -> pa.Table:
    """A row for each query and part of its node, with the probability of the path."""
    if not len(rows):
        return rows.select(["key", "v", "node", "p"])
    p = np.ones((len(rows), 1))
    if len(models):
        p = Router.unpacked(models["model"][0].as_py()).probabilities(unit(_matrix(rows["v"])))
    at = np.repeat(np.arange(len(rows)), p.shape[1])
    nodes = pa.array([f"{a}/{i}" for a in rows["node"].to_pylist() for i in range(p.shape[1])], pa.string())
    taken = rows.take(pa.array(at))
    return pa.table({"key": taken["key"], "v": taken["v"], "node": nodes, "p": pa.array((p * rows["p"].to_numpy()[:, None]).ravel())})


def compared(k: int):
    """A function of (queries, entries) of a pair of blocks: the k + 1 nearest ids of each query, by cosine."""

    def compare(queries: pa.Table, data: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if len(queries) and len(data):
            a, b = unit(_matrix(queries["v"])), unit(_matrix(data["v"]))
            own = data["ids"].to_pylist()
            names = queries["key"].to_pylist()
            near = a @ b.T
            for i, name in enumerate(names):
                most = min(len(own), 4 * (k + 1))
                while True:
                    at = np.argpartition(-near[i], most - 1)[:most]
                    exact = np.einsum("ij,j->i", b[at], a[i])
                    best: dict[int, float] = {}
                    for s, j in sorted((-exact[x], j) for x, row in enumerate(at) for j in own[row]):
                        best.setdefault(j, -s)
                    if len(best) > k or most == len(own):
                        break
                    most = min(len(own), 2 * most)
                for j, s in list(best.items())[: k + 1]:
                    keys.append(name)
                    ids.append(j)
                    scores.append(min(1.0, max(-1.0, float(s))))
        return pa.table({"key": pa.array(keys, pa.string()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return compare


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, mass: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row the k nearest others that are found, by cosine."""
    found = written(entries(vectors, k, vec_id, embedding), "entries")
    x = F.col(embedding)
    queries = written(vectors.where(F.coalesce(is_query, F.lit(False)) & F.col(vec_id).isNotNull() & x.isNotNull()).select(F.col(vec_id).cast("bigint").alias("query_id"), vector_key(x).alias("key")).distinct(), "queries")
    index = Index(found)
    asked = written(found.select("key", "v").join(queries.select("key").distinct(), "key", "left_semi"), "asked")
    met = written(index.route(asked, mass, k + 1), "met")
    data = written(index.rows, "index")
    held = data.groupBy("node").agg(_blocks(F.count("*"), DATA_BLOCK).alias("n_d"))
    asks = met.groupBy("node").agg(_blocks(F.count("*"), QUERY_BLOCK).alias("n_q"))
    blocks = written(held.join(asks, "node"), "blocks")
    left = met.join(blocks, "node").withColumn("q", _block("key", F.col("n_q"))).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("n_d") - 1))).select("node", "q", "d", "key", "v")
    right = data.join(blocks, "node").withColumn("d", _block("key", F.col("n_d"))).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).select("node", "q", "d", "v", "ids")
    pairs = left.groupBy("node", "q", "d").cogroup(right.groupBy("node", "q", "d")).applyInArrow(compared(k), "key string, vec_id bigint, score double")
    best = pairs.groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    best = written(best.withColumn("turn", turn).where(F.col("turn") <= k + 1).drop("turn"), "best")
    answers = queries.join(best, "key").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
