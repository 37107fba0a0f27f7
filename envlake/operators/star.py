"""Dimensions and facts of the measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import PARAMETERS, UNKNOWN_UNIT
from ..functions.times import day_parts, utc_day
from .keys import assert_unique, dimension_keys
from .quality import guard, require_columns
from .statistics import alerts, rolling_mean

# The published columns of the dimension of stations.
STATION_COLUMNS = ("codigo_origem", "nome_estacao", "status_estacao", "id_cidade", "nome_cidade", "codigo_ibge_cidade", "sigla_estado", "nome_estado")


def dim_station(measures: DataFrame, stations: DataFrame | None = None, cities: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """Every station that has measures, in order of its id, with what the registers say of it."""
    keys = measures.select("id_estacao").distinct()
    if stations is not None:
        found = assert_unique(stations, ["id_estacao"], "the stations")
        if cities is not None:
            found = found.join(assert_unique(cities, ["id_cidade"], "the cities").drop("id_estado_cidade"), "id_cidade", "left")
        if cities is not None and states is not None:
            found = found.join(assert_unique(states, ["id_estado"], "the states"), "id_estado", "left")
        keys = keys.join(found, "id_estacao", "left")
    kept = [F.col(c) if c in keys.columns else F.lit(None).cast("string").alias(c) for c in STATION_COLUMNS]
    return dimension_keys(keys.select("id_estacao", *kept), "sk_estacao", ["id_estacao"]).select("sk_estacao", "id_estacao", *STATION_COLUMNS)


def dim_parameter(measures: DataFrame) -> DataFrame:
    """Every code that has measures; one that is not in the catalogue is its own name."""
    catalogue = measures.sparkSession.createDataFrame(PARAMETERS, "codigo_parametro string, nome string, unidade string")
    found = measures.select("codigo_parametro").distinct().join(catalogue, "codigo_parametro", "left")
    found = found.select("codigo_parametro", F.coalesce("nome", "codigo_parametro").alias("nome_parametro"), F.coalesce("unidade", F.lit(UNKNOWN_UNIT)).alias("unidade_medida"))
    return dimension_keys(found, "sk_parametro", ["codigo_parametro"]).select("sk_parametro", "codigo_parametro", "nome_parametro", "unidade_medida")


def dim_time(measures: DataFrame) -> DataFrame:
    """Every UTC day that has measures."""
    days = measures.select(utc_day(F.col("data_leitura")).alias("data")).distinct()
    parts = day_parts(F.col("data"))
    return dimension_keys(days, "sk_tempo", ["data"]).select("sk_tempo", "data", *[c.alias(name) for name, c in parts.items()])


def fact_measures(measures: DataFrame, station: DataFrame, parameter: DataFrame, time: DataFrame, factor: float = 1.5, limit: float = 3.0) -> DataFrame:
    """Each measure with its three keys, its flags and its rolling mean; a key that is missing is an error."""

    def with_keys(series: DataFrame) -> DataFrame:
        """Stations and parameters grow with the data, so their keys are found for the few series, not for each row."""
        series = series.join(station.select("sk_estacao", "id_estacao"), "id_estacao", "left")
        return series.join(parameter.select("sk_parametro", "codigo_parametro"), "codigo_parametro", "left")

    rows = alerts(measures, factor=factor, limit=limit, of_series=with_keys)
    rows = rolling_mean(rows, ("dataset", "id_estacao", "codigo_parametro"), ("data_leitura", "id_leitura_origem"), counted=measures)
    rows = rows.withColumn("_day", utc_day(F.col("data_leitura")))
    rows = rows.join(time.select("sk_tempo", F.col("data").alias("_day")), "_day", "left")
    found = lambda key, of: F.coalesce(key, F.raise_error(F.concat(F.lit(f"a measure without a {key} for "), F.coalesce(F.col(of).cast("string"), F.lit("null")))).cast("bigint")).alias(key)
    return rows.select(found("sk_estacao", "id_estacao"), found("sk_tempo", "_day"), found("sk_parametro", "codigo_parametro"), "dataset", "id_leitura_origem", "data_leitura", F.col("valor").alias("valor_lido"), "media_movel", "anomalia_iqr", "anomalia_zscore", "alerta_qualidade")


def star_schema(measures: DataFrame, stations: DataFrame | None = None, cities: DataFrame | None = None, states: DataFrame | None = None, factor: float = 1.5, limit: float = 3.0) -> dict[str, DataFrame]:
    """The four tables of the published star schema."""
    require_columns(measures, ("dataset", "id_estacao", "codigo_parametro", "unidade_medida", "id_leitura_origem", "data_leitura", "valor"))
    guard(measures, {"no instant": F.col("data_leitura").isNull()}, "the measures")
    if measures.isEmpty():
        raise ValueError("there are no measures")
    station, parameter, time = dim_station(measures, stations, cities, states), dim_parameter(measures), dim_time(measures)
    fact = fact_measures(measures, station, parameter, time, factor, limit)
    return {"Dim_Estacao": station, "Dim_Parametro": parameter, "Dim_Tempo": time, "Fato_Medicoes": fact}
