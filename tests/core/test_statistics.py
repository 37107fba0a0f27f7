from math import sqrt

import pytest
from pyspark.sql import functions as F

from envlake.operators import statistics as st

SCHEMA = "dataset string, id_estacao bigint, codigo_parametro string, unidade_medida string, id_leitura_origem string, data_leitura timestamp, valor double"


def series(spark, values, station=1):
    from datetime import datetime, timedelta

    rows = [("d", station, "PH", "pH", f"r{i:03}", datetime(2026, 1, 1) + timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def test_describe_four_values(spark):
    r = st.describe(series(spark, [1.0, 2.0, 3.0, 4.0])).first()
    assert (r.n_validos, r.n_invalidos, r.media, r.mediana, r.q1, r.q3, r.iqr, r.ddof) == (4, 0, 2.5, 2.5, 1.75, 3.25, 1.5, 1)
    assert r.variancia == pytest.approx(5 / 3) and r.desvio_padrao == pytest.approx(sqrt(5 / 3))


@pytest.mark.parametrize("values, median, iqr", [([1, 2], 1.5, 0.5), ([1, 2, 3], 2, 1), ([-5, -5, 0, 5, 5], 0, 10), ([7, 7, 7], 7, 0)])
def test_quartiles(spark, values, median, iqr):
    r = st.describe(series(spark, [float(v) for v in values])).first()
    assert (r.mediana, r.iqr) == (median, iqr)


def test_invalid_measures_are_counted_and_groups_without_a_valid_one_dropped(spark):
    inf = float("inf")
    r = st.describe(series(spark, [1.0, 3.0, None, inf, -inf, float("nan")])).first()
    assert (r.media, r.n_validos, r.n_invalidos) == (2, 2, 4)
    one = st.describe(series(spark, [7.0])).first()
    assert one.desvio_padrao is None and one.variancia is None
    assert st.describe(series(spark, [None, inf])).count() == 0
    with pytest.raises(Exception, match="unidade_medida"):
        st.describe(series(spark, [1.0]).withColumn("unidade_medida", F.lit(None).cast("string"))).collect()


def test_z_scores_flag_beyond_the_limit_alone(spark):
    rows = st.z_scores(series(spark, [0.0] * 10 + [100.0])).orderBy("id_leitura_origem").collect()
    assert rows[-1].z_score == pytest.approx(10 / sqrt(11)) and [r.anomalia_zscore for r in rows] == [False] * 10 + [True]
    flags = lambda limit: [r.anomalia_zscore for r in st.z_scores(series(spark, [-1.0, 0.0, 1.0]), limit=limit).orderBy("id_leitura_origem").collect()]
    assert flags(1) == [False] * 3 and flags(0.5) == [True, False, True]
    for bad in (True, "3", 0, -1, float("inf"), float("nan")):
        with pytest.raises(ValueError):
            st.z_scores(series(spark, [1.0]), limit=bad)


def test_states_of_scores(spark):
    states = lambda v: {r.status_zscore for r in st.z_scores(series(spark, v)).collect()}
    assert states([1.0]) == {st.FEW} and states([2.0, 2.0]) == {st.CONSTANT} and states([None]) == {st.INVALID} and states([1.0, 2.0]) == {st.DONE}
    few = st.z_scores(series(spark, [1.0])).first()
    assert few.z_score is None and few.anomalia_zscore is None


def test_iqr_and_alerts(spark):
    rows = st.alerts(series(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None])).orderBy("id_leitura_origem").collect()
    assert [r.anomalia_iqr for r in rows] == [False] * 4 + [True, None] and rows[0].limite_superior_iqr == 7
    assert [r.alerta_qualidade for r in rows] == [False] * 4 + [True, None]
    assert rows[-1].status_iqr == st.INVALID
    one = st.alerts(series(spark, [5.0])).first()
    assert one.anomalia_iqr is False and one.anomalia_zscore is None and one.alerta_qualidade is False


def test_relational_dialect(spark):
    rows = st.sql_anomalies(series(spark, [1.0, 2.0, 3.0, 4.0, 20.0])).collect()
    r = rows[0]
    assert (r.n, r.media, r.mediana, r.variancia, r.q1, r.q3, r.limite_inferior, r.limite_superior) == (5, 6, 3, 62.5, 2, 4, -1, 7)
    last = st.sql_anomalies(series(spark, [0.0] * 10 + [100.0])).orderBy("id_leitura_origem").collect()[-1]
    assert last.anomalia_iqr and last.anomalia_z
    assert {(r.z_score, r.anomalia_z) for r in st.sql_anomalies(series(spark, [2.0, 2.0])).collect()} == {(None, False)}


def test_rolling_mean_takes_seven_rows(spark):
    got = [r.media_movel for r in st.rolling_mean(series(spark, [1.0, None, 3.0, 4.0, 100.0, 6.0, 7.0, 8.0, 9.0]), ["id_estacao"], ["data_leitura"]).orderBy("data_leitura").collect()]
    assert got[0] == got[1] == 1 and got[4] == 27 and got[8] == pytest.approx((3 + 4 + 100 + 6 + 7 + 8 + 9) / 7)


def test_a_hot_series_is_cut_into_ranges(spark):
    import random

    rng = random.Random(3)
    rows = [("hot", i, rng.choice([None, float("nan"), rng.random()])) for i in range(700)] + [(f"s{i % 40}", i, rng.random()) for i in range(1300)] + [(None, i, 1.0 * i) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, t int, valor double").repartition(5)
    whole = st.rolling_mean(df, ["s"], ["t"])
    cut = st.rolling_mean(df, ["s"], ["t"], most=50)
    assert "_range" in cut._jdf.queryExecution().optimizedPlan().toString() and cut.columns == whole.columns
    key = lambda r: (r.s or "", r.t)
    a, b = ([(r.s, r.t, None if r.media_movel is None else round(r.media_movel, 12)) for r in sorted(x.collect(), key=key)] for x in (whole, cut))
    assert a == b and len(a) == len(rows)
    single = st.rolling_mean(df, ["s"], ["t"], most=3)  # ranges are never shorter than the frame
    assert [(r.s, r.t, None if r.media_movel is None else round(r.media_movel, 12)) for r in sorted(single.collect(), key=key)] == a


def test_rolling_mean_counts_the_cheaper_table(spark):
    rows = series(spark, [2.0, 4.0, 6.0])
    dear = rows.withColumn("id_estacao", F.when(F.col("valor") > 5, F.raise_error(F.lit("it ran")).cast("bigint")).otherwise(F.col("id_estacao")))
    found = st.rolling_mean(dear, ["id_estacao"], ["data_leitura"], rows=2, counted=rows)
    with pytest.raises(Exception, match="it ran"):
        found.collect()
    whole = st.rolling_mean(rows, ["id_estacao"], ["data_leitura"], rows=2, most=1, counted=rows)
    assert sorted(r.media_movel for r in whole.collect()) == [2.0, 3.0, 5.0]


def test_alerts_bring_more_columns_of_the_series(spark):
    rows = series(spark, [1.0, 2.0, None]).unionByName(series(spark, [5.0], station=None))
    seen = []
    found = st.alerts(rows, of_series=lambda s: seen.append(s.count()) or s.withColumn("more", F.coalesce("id_estacao", F.lit(-1)))).collect()
    assert seen == [2] and sorted(r.more for r in found) == [-1, 1, 1, 1]
