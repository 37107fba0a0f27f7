"""Dense positions without a window over a group."""

from pyspark.sql import functions as F

from envlake.operators.keys import dense_positions, dimension_keys, prefix_sums


def test_positions_are_those_of_a_window_and_equal_rows_are_dealt_over_tasks(spark):
    rows = [("hot", 7)] * 500 + [("hot", i % 90) for i in range(400)] + [(None, i) for i in range(30)] + [("a", None), ("a", 3)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    found = dense_positions(df, [F.col("v").asc_nulls_first()], ["g"], rows="n")
    key = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)
    want, seen = [], {}
    for g, v in sorted(rows, key=key):
        seen[g] = seen.get(g, -1) + 1
        want.append((g, v, seen[g], sum(x[0] == g for x in rows)))
    assert sorted(map(tuple, found.collect()), key=lambda r: (*key(r), r[2])) == want


def test_keys_of_a_large_dimension_have_no_window_over_its_rows(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k"))
    found = dimension_keys(df, "sk", ["k"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    assert found.where("sk < 1 or sk > 200000").isEmpty()
    assert found.select("sk").distinct().count() == 200_000
    wrong = found.alias("a").join(found.alias("b"), F.col("a.sk") + 1 == F.col("b.sk")).where("a.k >= b.k")
    assert wrong.isEmpty()


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert dense_positions(df, ["v"], ["g"], rows="n").columns == ["g", "v", "position", "n"]
    assert dimension_keys(df, "sk", ["v"]).count() == 0


def test_prefix_sums_are_those_of_a_window(spark):
    rows = [("hot", 7, 3)] * 400 + [("hot", i % 90, i) for i in range(300)] + [(None, i, 2) for i in range(30)] + [("a", 3, 0)]
    df = spark.createDataFrame(rows, "g string, v int, n bigint").repartition(6)
    found = prefix_sums(df, "n", ["v", "n"], ["g"])
    want, seen = [], {}
    for g, v, n in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        want.append((g, v, n, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + n
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert prefix_sums(df.limit(0), "n", ["v"]).count() == 0
