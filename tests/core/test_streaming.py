from datetime import date

from pyspark.sql import functions as F

from envlake.streaming.ingest import daily_counts, dedup_stream


def test_days_are_counted_with_late_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [("2026-01-01 10:00:00", "a"), ("2026-01-01 23:59:59", "a"), ("2026-01-03 00:00:00", "b")]
    spark.createDataFrame(rows, "t string, kind string").coalesce(1).write.json(folder)
    stream = spark.readStream.schema("t string, kind string").json(folder).withColumn("ts", F.to_timestamp("t"))
    query = daily_counts(stream, "ts", ["kind"]).writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {tuple(r) for r in spark.table("days").collect()} == {(date(2026, 1, 1), "a", 2), (date(2026, 1, 3), "b", 1)}


def test_the_first_row_of_a_key_stays_over_batches(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    for rows in ([(1, "a"), (1, "b"), (2, "c")], [(1, "0"), (3, "d")]):
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").json(folder)
        stream = spark.readStream.schema("k int, v string").json(folder)
        dedup_stream(stream, ["k"], table, str(tmp_path / "checkpoint"), ["v"]).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("k", "v").collect()) == [(1, "a"), (2, "c"), (3, "d")]
