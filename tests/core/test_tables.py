import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from envlake.domain import WATER, WEATHER
from envlake.sources import tables

SCHEMA = "id_leitura_origem string, id_estacao bigint, data_leitura timestamp, temperatura_agua double, ph double, oxigenio double, condutividade double, turbidez double"


def water(spark, *rows):
    return spark.createDataFrame([(i, 1, datetime.fromisoformat(t), v, 7.0, 5.0, 100.0, 1.0) for i, t, v in rows], SCHEMA)


def content(spark, folder):
    return sorted((r.id_leitura_origem, str(r.dia_utc), r.temperatura_agua) for r in tables.read_table(spark, f"{folder}/qualidade_agua").collect())


def test_a_replay_writes_nothing_and_late_days_are_opened_again(spark, tmp_path):
    folder = str(tmp_path)
    df = water(spark, ("a", "2026-05-20T10:00:00", 1.0), ("b", "2026-05-21T10:00:00", 2.0), ("a", "2026-05-20T11:00:00", 3.0))
    done = tables.merge(df, WATER, folder, ["data_leitura"])
    assert (done.received, done.written, done.days) == (3, 2, ["2026-05-20", "2026-05-21"])
    assert done.dimensions["uniqueness"] == {"linhas_avaliadas": 3, "linhas_aprovadas": 2, "linhas_rejeitadas": 1}
    assert json.loads(Path(done.manifest).read_text())["linhas_gravadas"] == 2
    again = tables.merge(df, WATER, folder, ["data_leitura"])
    assert (again.written, again.days) == (0, []) and Path(again.manifest).exists()
    late = tables.merge(water(spark, ("c", "2026-05-20T01:00:00", 9.0), ("b", "2026-05-25T00:00:00", 9.0)), WATER, folder)
    assert late.written == 1  # a key that another day has stays what it was
    assert content(spark, folder) == [("a", "2026-05-20", 1.0), ("b", "2026-05-21", 2.0), ("c", "2026-05-20", 9.0)]
    assert not list(tmp_path.glob("_stage/*")) and [p.suffix for p in tmp_path.glob("*.lease/*") if not p.name.startswith(".")] == [".free"]


def test_new_columns_are_added_and_empty_batches_have_a_manifest(spark, tmp_path):
    folder = str(tmp_path)
    tables.merge(water(spark, ("a", "2026-05-20T10:00:00", 1.0)), WATER, folder)
    tables.merge(water(spark, ("b", "2026-05-20T12:00:00", 1.0)).withColumn("extra", F.lit("x")), WATER, folder)
    assert {r.id_leitura_origem: r.extra for r in tables.read_table(spark, f"{folder}/qualidade_agua").collect()} == {"a": None, "b": "x"}
    empty = tables.merge(spark.createDataFrame([], SCHEMA), WATER, folder)
    assert (empty.received, empty.written) == (0, 0) and Path(empty.manifest).exists()


def utc(day):
    return datetime.fromisoformat(day).replace(tzinfo=timezone.utc)


def test_rebuild_replaces_days_and_empties_those_without_rows(spark, tmp_path):
    folder = str(tmp_path)
    tables.merge(water(spark, ("a", "2026-05-20T10:00:00", 1.0), ("b", "2026-05-21T10:00:00", 2.0), ("c", "2026-05-22T10:00:00", 3.0)), WATER, folder)
    done = tables.rebuild(lambda: water(spark, ("a2", "2026-05-20T10:00:00", 5.0)), WATER, folder, utc("2026-05-20"), utc("2026-05-22"))
    assert done.days == ["2026-05-20", "2026-05-21"]
    assert content(spark, folder) == [("a2", "2026-05-20", 5.0), ("c", "2026-05-22", 3.0)]
    parts = json.loads(Path(done.manifest).read_text())["particoes"]
    assert [(p["linhas_anteriores"], p["linhas_finais"]) for p in parts] == [(1, 1), (1, 0)]


@pytest.mark.parametrize(
    "rows, match",
    [
        ([("x", "2026-05-20T10:00:00", 99.0)], "quality"),
        ([("x", "2026-05-20T10:00:00", 1.0), ("x", "2026-05-20T11:00:00", 1.0)], "repeats"),
        ([("x", "2026-05-22T00:00:00", 1.0)], "outside the window"),
        ([("c", "2026-05-20T10:00:00", 1.0)], "day outside"),
    ],
)
def test_a_rebuild_that_breaks_a_rule_changes_nothing(spark, tmp_path, rows, match):
    folder = str(tmp_path)
    tables.merge(water(spark, ("a", "2026-05-20T10:00:00", 1.0), ("c", "2026-05-22T10:00:00", 3.0)), WATER, folder)
    before = content(spark, folder)
    with pytest.raises(ValueError, match=match):
        tables.rebuild(lambda: water(spark, *rows), WATER, folder, utc("2026-05-20"), utc("2026-05-22"))
    assert content(spark, folder) == before
    with pytest.raises(ValueError):
        tables.rebuild(lambda: None, WATER, folder, datetime(2026, 5, 20), utc("2026-05-22"))


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("cast(id as string) as id_leitura_origem", "1L as id_estacao", "timestamp'2026-05-20' + make_interval(0,0,0,0,0,0,id) as data_leitura", "1d as temperatura_agua", "7d as ph", "1d as oxigenio", "1d as condutividade", "1d as turbidez")
        assert tables.merge(df, WATER, str(tmp_path)).written == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "qualidade_agua").rglob("part-*.parquet"))) > 1


def test_reports_as_sorted_parts(spark, tmp_path):
    df = spark.range(1000).selectExpr("999 - id as a", "timestamp'2026-01-01' as t")
    tables.write_csv_parts(df, str(tmp_path / "out"), ["a"])
    lines = [x for p in sorted((tmp_path / "out").glob("part-*.csv")) for x in p.read_text().splitlines()]
    assert [x for x in lines if x != "a;t"] == [f"{i};2026-01-01 00:00:00.000000+00:00" for i in range(1000)]


def test_csv_dialect(spark, tmp_path):
    df = spark.createDataFrame([(2, None, True, "é;x"), (1, 1.5, False, None)], "a int, b double, c boolean, d string")
    tables.write_csv(df, str(tmp_path / "out.csv"), ["a"])
    raw = (tmp_path / "out.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and raw.decode("utf-8-sig") == 'a;b;c;d\n1;1.5;False;\n2;;True;"é;x"\n'
    tables.write_csv(df, str(tmp_path / "out.csv"), ["a"])
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out.csv"]
    with pytest.raises(ValueError):
        tables.write_star({"t": df}, str(tmp_path / "silver" / "gold"), str(tmp_path / "silver"))
    assert WEATHER.numeric == ("temperatura_ar", "umidade", "chuva", "vento")
