"""What a task reads, and how often rows are made, must not follow the size of a table."""

import numpy as np
from pyspark.sql import functions as F

from envlake.domain import WATER
from envlake.operators import quantiles
from envlake.plans import medallion, relational
from envlake.plans.queries import queries
from envlake.sources import tables
from envlake.streaming import ingest


def test_a_published_file_is_read_again_by_many_tasks(spark, data):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = queries()["sorted_publish"](spark, data)
        per_task = [r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        places = [r.place for r in rows.select("place").orderBy("place").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert max(per_task) * 2 < sum(per_task) and places == list(range(1, sum(per_task) + 1))


def test_lines_are_numbered_over_ranges_of_a_file(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"{i}{'x' * (i % 50)}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = tables.numbered_lines(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.place, r.line) for r in found) == [(i, f"{i}{'x' * (i % 50)}") for i in range(3000)]


def test_small_groups_need_no_sketch_and_large_ones_are_told_from_them(spark, monkeypatch):
    sketched = []
    real = quantiles.F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a: sketched.append(a) or real(*a))
    df = spark.range(9000).selectExpr("if(id < 6000, null, cast(id % 300 as string)) as k", "cast(id * 7919 % 4001 as double) as v")
    by_value = {r.k: (r.n, r.a, r.b) for r in quantiles.exact_quantiles(df, ["k"], "v", (0.25, 0.9), ("a", "b"), [F.count("*").alias("n")]).collect()}
    assert not sketched and len(by_value) == 301
    monkeypatch.setattr(quantiles, "LEAST_LARGE", 100)
    mixed = {r.k: (r.n, r.a, r.b) for r in quantiles.exact_quantiles(df, ["k"], "v", (0.25, 0.9), ("a", "b"), [F.count("*").alias("n")]).collect()}
    assert len(sketched) == 1 and mixed == by_value
    own = np.array([i * 7919 % 4001 for i in range(6000)], dtype=float)
    assert mixed[None] == (6000, *np.quantile(own, [0.25, 0.9]))


def counted(spark, c):
    """(column c through a function that counts its calls, the count)."""
    calls = spark.sparkContext.accumulator(0)

    def same(x):
        calls.add(1)
        return x

    return F.udf(same, "string")(c), calls


def water_lines(spark, folder, n, name="1"):
    body = F.concat(F.lit('{"record":{"id":"'), F.col("id"), F.lit('","estacao_id":"E1","timestamp":"2026-01-01T10:00:00Z","qualidade_agua":{"temperatura":{"valor":20},"ph":{"valor":7},"oxigenio_dissolvido":{"valor":7},"condutividade":{"valor":7},"turbidez":{"valor":7}}}}'))
    spark.range(n).select(body.alias("value")).write.text(f"{folder}/api_qualidade_agua_{name}.jsonl")


STATIONS = "codigo_origem string, id_estacao bigint, id_cidade bigint"


def test_a_stream_parses_a_line_once(spark, tmp_path, monkeypatch):
    real, seen = ingest.flatten, []

    def flatten(raw, dataset):
        flat = real(raw, dataset)
        column, calls = counted(spark, "codigo_estacao")
        seen.append(calls)
        return flat.withColumn("codigo_estacao", column)

    monkeypatch.setattr(ingest, "flatten", flatten)
    water_lines(spark, tmp_path / "in", 50)
    stations = spark.createDataFrame([("E1", 1, 1)], STATIONS)
    done = []
    ingest.merge_stream(spark, str(tmp_path / "in"), WATER.name, str(tmp_path / "silver"), str(tmp_path / "check"), lambda rows: medallion.resolve(rows, WATER, stations), done.append).awaitTermination()
    assert done[0].written == 50 and [c.value for c in seen] == [50]
    assert not list((tmp_path / "silver" / "_stage").iterdir())


def test_a_day_of_one_instant_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(4000).selectExpr("cast(id as string) as id_leitura_origem", "1L as id_estacao", "timestamp'2026-05-20' as data_leitura", "1d as temperatura_agua", "7d as ph", "1d as oxigenio", "1d as condutividade", "1d as turbidez")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tables.merge(df, WATER, str(tmp_path)).written == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "qualidade_agua").rglob("dia_utc=*/part-*.parquet"))) > 1


def test_a_merge_computes_its_rows_once(spark, tmp_path):
    column, calls = counted(spark, F.col("id").cast("string"))
    df = spark.range(60).select(column.alias("id_leitura_origem"), F.lit(1).cast("bigint").alias("id_estacao"), F.lit("2026-01-01").cast("timestamp").alias("data_leitura"), *[F.lit(7.0).alias(c) for c in WATER.numeric])
    assert tables.merge(df, WATER, str(tmp_path)).written == 60 and calls.value == 60


def test_a_load_parses_a_line_once(spark, tmp_path, monkeypatch):
    real, seen = medallion.flatten, []

    def flatten(raw, dataset):
        column, calls = counted(spark, "codigo_estacao")
        seen.append(calls)
        return real(raw, dataset).withColumn("codigo_estacao", column)

    monkeypatch.setattr(medallion, "flatten", flatten)
    water_lines(spark, tmp_path / "in", 50)
    stations = spark.createDataFrame([("E1", 1, 1)], STATIONS)
    assert medallion.load(spark, str(tmp_path / "in"), str(tmp_path / "silver"), stations, [WATER.name])[WATER.name].table.written == 50
    medallion.backfill(spark, str(tmp_path / "in"), str(tmp_path / "silver"), stations, WATER.name, "2026-01-01", "2026-01-02", replace=True)
    assert [c.value for c in seen] == [50, 50]


def test_a_load_of_events_reads_them_once(spark, tmp_path):
    column, calls = counted(spark, F.col("id").cast("string"))
    rows = spark.range(40).select(column.alias("id_leitura_origem"), F.lit(1).alias("id_estacao"), F.lit("2026-01-01").cast("timestamp").alias("data_leitura"), *[F.lit("7").alias(c) for c in WATER.codes])
    done = relational.persist(relational.prepare(rows, WATER), str(tmp_path / "tables"))
    assert done.counts == {"insert": 40} and calls.value == 40
    assert [p.name for p in (tmp_path / "tables" / "_judged").iterdir()] == [relational.current(spark, str(tmp_path / "tables")).content["judged"][0].split("/")[1]]
