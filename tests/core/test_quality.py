import pytest
from pyspark.sql import functions as F

from envlake.domain import WATER, WEATHER, contract
from envlake.operators import joins, keys, quality, star, upsert
from envlake.operators.reshape import measurements

WATER_SCHEMA = "id_leitura_origem string, id_estacao bigint, data_leitura string, temperatura_agua string, ph string, oxigenio double, condutividade double, turbidez double"


def water(spark, **changes):
    base = dict(id_leitura_origem="a", id_estacao=1, data_leitura="2026-05-20T12:00:00-03:00", temperatura_agua="20", ph="7", oxigenio=5.0, condutividade=100.0, turbidez=1.0)
    return tuple((base | changes).values())


def test_water_dimensions_are_independent(spark):
    rows = [water(spark), water(spark, id_leitura_origem="  "), water(spark, id_leitura_origem="b", data_leitura="ontem"), water(spark, id_leitura_origem="c", temperatura_agua="50.1"), water(spark, id_leitura_origem="d", ph="14.5"), water(spark, id_leitura_origem="e", turbidez=float("inf"))]
    clean, counts = quality.assess(spark.createDataFrame(rows, WATER_SCHEMA), WATER)
    got = {r.dimension: (r.evaluated, r.approved, r.rejected) for r in quality.dimension_counts(counts, (1, 1)).collect()}
    assert clean.count() == 1 and got == {"completeness": (6, 4, 2), "accuracy": (6, 5, 1), "validity": (6, 4, 2), "timeliness": (6, 5, 1), "consistency": (6, 6, 0), "uniqueness": (1, 1, 0)}
    assert str(clean.first().data_leitura) == "2026-05-20 15:00:00"


def test_limits_are_inclusive(spark):
    rows = [(1, 1, "2026-01-01T00:00:00Z", v, 50.0, 0.0, 0.0, "sol") for v in (-50.0, 60.0, -50.1, 60.1, float("nan"))]
    df = spark.createDataFrame(rows, "id_estacao bigint, id_cidade bigint, data_leitura string, temperatura_ar double, umidade double, chuva double, vento double, condicao string")
    assert quality.assess(df, WEATHER)[0].count() == 2
    with pytest.raises(ValueError):
        quality.assess(df.drop("vento"), WEATHER)
    with pytest.raises(ValueError):
        contract("other")


def test_reasons_and_guard(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "a int, b int")
    accepted, rejected = quality.split(df, {"low": F.col("b") < 0, "none": F.col("b").isNull()})
    assert [r.a for r in accepted.collect()] == [1]
    assert {r.reason: r.n for r in quality.reason_counts(rejected).collect()} == {"low": 1, "none": 1}
    with pytest.raises(ValueError, match="low in 1"):
        quality.guard(df, {"low": F.col("b") < 0}, "it")


def test_first_of_a_key_and_conflicts(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("b", 1, None), ("b", 2, None)], "k string, n int, v int")
    assert {(r.k, r.n) for r in keys.keep_first(df, ["k"], ["n"]).collect()} == {("a", 1), ("b", 1)}
    assert [r.k for r in keys.conflicting_keys(df, ["k"], ["v"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        keys.assert_unique(df, ["k"])


def test_lookups_and_references(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    found, unmatched = joins.lookup(df, dim, ["k"])
    assert [r.v for r in found.collect()] == ["x"] and sorted(r.v for r in unmatched.collect()) == ["y", "z"]
    assert [r.v for r in joins.orphans(df, dim, {"k": "k"}).collect()] == ["y"]
    with pytest.raises(ValueError):
        joins.lookup(df, dim.union(dim), ["k"])
    with pytest.raises(ValueError):
        joins.delete_with_children(dim, df, dim, "k", "k", cascade=False)
    places = spark.createDataFrame([(7, "São José", "SC")], "id int, place string, state string")
    rows = spark.createDataFrame([("SAO-JOSE", " sc "), ("Floripa", "SC")], "city string, uf string")
    got = {r.city: r.id for r in joins.match_places(rows, places, "city", "uf", {("SC", "floripa"): "saojose"}).collect()}
    assert got == {"SAO-JOSE": 7, "Floripa": 7}


def test_verdicts(spark):
    old = spark.createDataFrame([(1, "s", None), (2, "s", "o"), (3, "s", "o")], "k int, station string, operator string")
    new = spark.createDataFrame([(0, "s", None), (1, "s", "p"), (2, "t", "o"), (3, "s", None)], "k int, station string, operator string")
    assert {r.k: r.verdict for r in upsert.classify(new, old, ["k"], ["station"], ["operator"]).collect()} == {0: "insert", 1: "enrich", 2: "reject", 3: "replay"}
    items = spark.createDataFrame([(1, "PH", 7.0, 0), (1, "OD", 5.0, 0), (1, "PH", 8.0, 1)], "k int, code string, value double, batch int")
    first = items.where("batch = 0")
    assert upsert.event_verdicts(first, items.where("batch = 1"), ["k"]).first().verdict == "reject"
    got = {r.id: (r.name, r.verdict) for r in upsert.upsert(spark.createDataFrame([(1, None), (2, "n")], "id int, name string"), spark.createDataFrame([(1, "a"), (3, "c")], "id int, name string"), ["id"], ["name"], keep_if_null=["name"]).collect()}
    assert got == {1: ("a", "replay"), 2: ("n", "insert"), 3: ("c", "replay")}


def test_star_schema(spark):
    df = spark.createDataFrame([("a", 9, "2026-05-22 10:00:00", 20.0, 7.0), ("b", 4, "2026-05-23 10:00:00", 21.0, 8.0)], "id_leitura_origem string, id_estacao bigint, t string, temperatura_agua double, ph double")
    long = measurements(df.withColumn("data_leitura", F.to_timestamp("t")), WATER)
    assert long.count() == 10
    tables = star.star_schema(long.where("valor is not null"))
    assert [(r.sk_estacao, r.id_estacao) for r in tables["Dim_Estacao"].orderBy("sk_estacao").collect()] == [(1, 4), (2, 9)]
    assert [(r.dia_semana, r.dia_util) for r in tables["Dim_Tempo"].orderBy("sk_tempo").collect()] == [(4, True), (5, False)]
    assert {r.codigo_parametro: r.unidade_medida for r in tables["Dim_Parametro"].collect()} == {"PH": "pH", "TEMP_AGUA": "Celsius"}
    fact = tables["Fato_Medicoes"]
    assert fact.count() == 4 and fact.where("sk_estacao is null or sk_tempo is null or sk_parametro is null").count() == 0
    with pytest.raises(ValueError):
        star.star_schema(long.limit(0))
    lost = star.fact_measures(long, tables["Dim_Estacao"].where("id_estacao = 9"), tables["Dim_Parametro"], tables["Dim_Tempo"])
    with pytest.raises(Exception, match="a measure without a sk_estacao for 4"):
        lost.collect()


def test_fact_finds_keys_by_series_and_keeps_odd_rows(spark):
    from datetime import datetime

    at = lambda h: datetime(2026, 1, 1, h)
    rows = [("d", 1, "PH", u, f"r{i}", at(i % 5), v) for i, (u, v) in enumerate([("u", 1.0), ("u", 1.0), ("u", float("nan")), ("u", None), (None, 5.0), (None, 7.0)])]
    rows += [rows[0], (None, 2, "OD", "u", "x", at(0), 3.0)]
    df = spark.createDataFrame(rows, "dataset string, id_estacao bigint, codigo_parametro string, unidade_medida string, id_leitura_origem string, data_leitura timestamp, valor double")
    tables = star.star_schema(df)
    fact = tables["Fato_Medicoes"]
    # a shuffle of all rows by station would follow their window; series are met below it
    plan = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
    found = [i for i, line in enumerate(plan) if "Join LeftOuter, (id_estacao" in line]
    assert found and min(found) > min(i for i, line in enumerate(plan) if "Window [" in line)
    got = sorted((r.id_leitura_origem, r.sk_estacao, r.sk_parametro, r.valor_lido, r.media_movel, r.anomalia_iqr, r.anomalia_zscore, r.alerta_qualidade) for r in fact.collect())
    assert got[0][:4] == got[1][:4] == ("r0", 1, 2, 1.0)
    by_id = {r[0]: r for r in got}
    assert len(got) == 8 and by_id["x"] == ("x", 2, 1, 3.0, 3.0, False, None, False)
    assert by_id["r2"][3] is by_id["r3"][3] is None and by_id["r2"][5] is by_id["r3"][7] is None
    assert by_id["r5"][5:] == (False, False, False) and by_id["r1"][6] is None  # a series of equal numbers has no score
    nobody = df.unionByName(spark.createDataFrame([("d", None, "PH", "u", "n", at(0), 1.0)], df.schema))
    with pytest.raises(Exception, match="a measure without a sk_estacao for null"):
        star.fact_measures(nobody, tables["Dim_Estacao"], tables["Dim_Parametro"], tables["Dim_Tempo"]).collect()
