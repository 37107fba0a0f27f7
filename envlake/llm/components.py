"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

EDGES_IN_A_FILE = 250_000


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b) reaches.

    First every task replaces its own edges, those of a file's size, by stars that
    connect the same nodes, so few edges need no rounds and many need fewer; each
    round costs the driver some twenty broadcasts of plans and tasks. Then
    large-star and small-star steps alternate: every node sends its larger, then
    its smaller neighbours to the smallest node it knows, until nothing changes.
    Each round is written, so that plans stay short and lost executors cost one
    round. Minima are combined before the shuffle and the joins have no aggregate
    above their exchange, so that Spark can split a node with very many edges.
    Edges with a null end are ignored.
    """
    pairs = written(edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    loops, now = pairs.where("u = v").select(F.col("u").alias("node")), pairs.where("u <> v")
    state = _state(now)
    files = 1 + state[0] // EDGES_IN_A_FILE
    now = written(now.coalesce(files).mapInArrow(_stars, "u bigint, v bigint"), "edges")
    state = _state(now) if files > 1 else (0,)
    while state[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # no round has more edges than the one before: a few files do for a few edges
        now = written(small.union(least).distinct().coalesce(1 + state[0] // EDGES_IN_A_FILE), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node")).union(loops).distinct().join(now, F.col("node") == F.col("u"), "left_anti")
    return found.union(roots.select("node", F.col("node").alias("component")))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node that it reaches by these edges), for nodes that reach a smaller one."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = top(u), top(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    nodes = [x for x in up if up[x] != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], names=["u", "v"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
