import hashlib
import zlib

from pyspark.sql import functions as F

from envlake.llm import merkle

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_of(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """(root, for each node its (left, right) siblings up to the root) of a list of digests."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for x, i in enumerate(own):
            run = runs[i // 8]
            paths[x].append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
            own[x] = i // 8
        nodes = [H(*run) for run in runs]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    lang = lambda v: (v is not None, (v or "").encode())
    groups = {}
    for doc_id, text, lg, source, n in rows:
        leaf = leaf_of([doc_id, source, lg, n, text])
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        altered = leaf_of([doc_id, source, lg, n, None if text is None else text.translate(LOWER)]) if hit else leaf
        groups.setdefault(lg, []).append((first(doc_id), leaf, doc_id, altered))
    order = sorted(groups, key=lang)
    trees = [climb([x[1] for x in sorted(groups[g])]) for g in order]
    root, above = climb([t[0] for t in trees])
    out = []
    for g, (sub, paths), top in zip(order, trees, above, strict=True):
        for (_, leaf, doc_id, altered), path in zip(sorted(groups[g]), paths, strict=True):
            cur = altered
            for left, right in path + top:
                cur = H(left, cur, right)
            out.append((doc_id, leaf, sub, root, H(*[a + b for a, b in path + top]), cur, cur == root))
    return sorted(out, key=str)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, idx int, h string, grp string, leaf string, top string, path string, root string"


def found(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, 3, "x", "y", "z", "t", "p", "r") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=str)


def test_trees_of_all_sizes_with_nulls_copies_ties_and_clashing_columns(spark):
    rows = [(i, f"Text {i} ÄÖ", "hot", "web", i) for i in range(600)]
    rows += [(7, "Same", "hot", None, 4)] * 90  # copies of a row
    rows += [(7, "Other", "hot", "a", 5), (None, "No id", "hot", "a", None), (None, None, None, None, None), (12, None, None, "b", 0)]
    rows += [(1000 + i, "", "eight", "s", 0) for i in range(8)] + [(2000 + i, "A" * i, "nine", "s", i) for i in range(9)]
    rows += [(3, "Lone ABC", "é", "s", 2), (4, "Lone", "z", "s", 2), (5, "", "", "", 0)] + [(3000 + i, "q", f"l{i:03}", "s", 1) for i in range(70)]
    assert found(spark, rows) == brute(rows)


def test_one_row_one_language_none_and_a_very_long_text(spark):
    for rows in ([(1, "A", "en", "s", 1)], [(i, "B", "en", "s", 1) for i in range(65)], [(6, "Word É " * 400_000, None, None, None), (9, "x", "de", "s", 1)]):
        assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_no_window_holds_a_group(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    nodes = merkle.manifest(merkle.document_leaves(df))
    assert nodes.select("subroot", "root").distinct().count() == 1
    assert nodes.select(F.max(F.size("path"))).first()[0] == 5  # 5000, 625, 79, 10, 2


def test_tampering_is_seen_where_it_changes_a_text(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "s", 5) for i in range(200)]
    for doc_id, *_, verified in found(spark, rows):
        assert verified == (not (doc_id % 2 and zlib.crc32(str(doc_id).encode()) % 3 == 0))
