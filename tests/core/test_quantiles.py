import numpy as np
import pytest

from envlake.operators import quantiles


@pytest.mark.parametrize("accuracy", [1, 4000])
def test_quantiles_of_odd_series(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = np.random.default_rng(accuracy)
    series = {
        "a": rng.normal(size=501).tolist(),
        "one": [7.0],
        "same": [2.0] * 40,
        "far": [0.0] * 99 + [1e12],
        "ties": rng.integers(0, 4, 200).astype(float).tolist(),
        None: [1.0, 2.0, 3.0, 4.0],
        "none": [],
    }
    rows = [(k, v) for k, values in series.items() for v in values] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: (r.a, r.b, r.c) for r in quantiles.exact_quantiles(df, ["k"], "v", (0.25, 0.5, 1.0), ("a", "b", "c")).collect()}
    assert got.keys() == series.keys() - {"none"}
    for k, found in got.items():
        assert found == pytest.approx(tuple(np.quantile(series[k], [0.25, 0.5, 1.0])), rel=1e-12)


def test_an_outlier_does_not_fill_one_class(spark, monkeypatch):
    held = []
    real = quantiles.Window.partitionBy

    def seen(*columns):
        held.append(columns)
        return real(*columns)

    monkeypatch.setattr(quantiles.Window, "partitionBy", staticmethod(seen))
    df = spark.range(100_000).selectExpr("0 as k", "if(id = 7, 1e12, cast(id as double)) as v")
    bounds = df.groupBy("k").agg(quantiles.F.percentile_approx("v", [0.25 - quantiles.BESIDE, 0.25 + quantiles.BESIDE], quantiles.ACCURACY).alias("b")).first().b
    inside = df.where(f"v between {bounds[0]} and {bounds[1]}").count()
    assert inside < 1000  # of 100,000: what a task looks at by value
    assert quantiles.exact_quantiles(df, ["k"], "v", (0.25,), ("q",)).first().q == np.quantile([1e12 if i == 7 else i for i in range(100_000)], 0.25) and ("k", "_class") in held
