"""Merkle manifest of a dataset: a tree of digests for each group, and a tree over the groups.

Window-based levels: nodes of a level are partitioned by group and parent index, and
one ordered full-frame collect_list supplies both what the parent hashes and the
siblings of its children. Of each run one row stays, the parent, before the next
level. A window so holds a fan-out of nodes at most, however large a group is, and
levels shrink by the fan-out. Places of leaves in their group come from a range sort
with prefix sums, not from a window over the group.

Proofs go down the same way: a node's path is its siblings and then its parent's
path, which only the parents, an eighth of the nodes, bring through a shuffle.

H is the lowercase hex SHA-256 of its inputs one after the other, digests as hex
text. A field is its UTF-8 byte count, ":" and its value, "-" if null.

Defined results: leaves ascend by id, null ids first; rows with one id by their
digest, so equal rows have equal leaves and neighbouring places; a group of one leaf
has that leaf as subroot, a dataset of one group its subroot as root; an empty table
gives no rows; texts of any length are hashed whole; other columns, whatever their
names, play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_positions
from .store import written

FAN_OUT = 8
#: The columns of a document that its leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """H of the values, each with its length in front."""
    text = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(text: Column) -> Column:
    """text with A-Z alone in lower case."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def fold(start: Column, path: Column) -> Column:
    """The digest at the top, from a leaf and what stands left and right of it on every level."""
    return F.aggregate(path, start, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def levels_of(nodes: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """nodes and the levels above them, (grp, idx, n, h, run): the last has one node of the largest group.

    nodes: (grp, idx, n, h, ...), a digest h for each place idx of the n of a group.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = [nodes]
    full = Window.partitionBy("grp", "parent").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    while most > 1:
        runs = levels[-1].where("n > 1").select("grp", "idx", "n", "h").withColumn("parent", F.expr(f"idx div {fan_out}")).withColumn("run", F.collect_list("h").over(full))
        parents = runs.where(F.col("idx") % fan_out == 0).select("grp", F.col("parent").alias("idx"), F.expr(f"(n + {fan_out - 1}) div {fan_out}").alias("n"), F.sha2(F.array_join("run", ""), 256).alias("h"), "run")
        levels.append(written(parents, "level"))
        most = -(-most // fan_out)
    return levels


def tops_of(levels: Sequence[DataFrame]) -> DataFrame:
    """(grp, h): what each group comes to."""
    return reduce(DataFrame.unionByName, [x.where("n = 1").select("grp", "h") for x in levels])


def paths_of(levels: Sequence[DataFrame], above: DataFrame | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """The nodes of the lowest level with `top`, what their group comes to, `root` and `path` up to the root.

    above: (grp, root, path) of each group's top in a tree of its own; without it, a
    group's top is its root.
    """
    known = None
    for rows in reversed(levels):
        found = rows.where("n = 1").withColumn("top", F.col("h"))
        if above is None:
            found = found.withColumn("root", F.col("h")).withColumn("path", F.array().cast(PATH))
        else:
            found = found.join(above.select(F.col("grp").alias("_grp"), "root", "path"), F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
        if known is not None:
            up = known.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("run").alias("_run"), "top", "root", F.col("path").alias("_path"))
            place = (F.col("idx") % fan_out).cast("int")
            own = F.struct(F.array_join(F.slice("_run", F.lit(1), place), "").alias("left"), F.array_join(F.slice("_run", place + 2, F.lit(fan_out)), "").alias("right"))
            below = rows.where("n > 1").join(up, F.col("grp").eqNullSafe(F.col("_grp")) & (F.expr(f"idx div {fan_out}") == F.col("_idx")))
            found = found.unionByName(below.withColumn("path", F.concat(F.array(own), F.col("_path"))).select(*rows.columns, "top", "root", "path"))
        known = found
    return known


def manifest(leaves: DataFrame, order: Sequence[str] = ("doc_id",), fan_out: int = FAN_OUT) -> DataFrame:
    """leaves, rows with a group `grp` and a digest `leaf`, with `subroot`, `root` and `path`.

    Groups are ordered by their own value, null first, strings bytewise.
    """
    sort = [F.col(c).asc_nulls_first() for c in (*order, "h")]
    nodes = dense_positions(leaves.withColumnRenamed("leaf", "h"), sort, ["grp"], name="idx", rows="n")
    levels = levels_of(nodes, fan_out)
    subroots = dense_positions(tops_of(levels), [F.col("grp").asc_nulls_first()], name="idx", rows="n")
    upper = levels_of(subroots.withColumnRenamed("grp", "of").withColumn("grp", F.lit(0)), fan_out)
    above = written(paths_of(upper, fan_out=fan_out).select(F.col("of").alias("grp"), "root", "path"), "above")
    found = paths_of(levels, above, fan_out).withColumnRenamed("h", "leaf")
    return found.select(*leaves.columns, F.col("top").alias("subroot"), "root", "path")


def document_leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, grp, leaf, altered): each document's leaf, and what it is if the text of every third id (by CRC-32) has been lower-cased."""
    changed = [ascii_lower(F.col(text)) if c == text else F.col(c) for c in fields]
    hit = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 0, F.lit(False))
    leaf = leaf_digest([F.col(c) for c in fields])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(group).alias("grp"), leaf.alias("leaf"), F.when(hit, leaf_digest(changed)).alias("altered"))


def audit(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document, its altered leaf folded where it has one."""
    found = manifest(document_leaves(docs))
    folded = found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
