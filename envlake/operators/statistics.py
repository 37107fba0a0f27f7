"""Descriptive statistics, anomalies, alerts and rolling means of long measurement tables.

A measure is valid if it is a finite number. Groups are aggregated before they are
shuffled and joined back to the rows, so that no task gets all rows of a large
series; where the groups are few, Spark sends them to the rows, which stay in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import finite
from ..functions.times import utc_day
from .keys import dense_positions
from .quantiles import exact_quantiles, join_groups

#: The series of the environmental measurements.
SERIES = ("dataset", "id_estacao", "codigo_parametro", "unidade_medida")
QUARTILES = (0.25, 0.5, 0.75)
#: Rows of a series that a task takes in order, beyond which the series is cut into ranges.
MOST_IN_TASK = 1_000_000
# The published states of a row's Z-score.
INVALID, FEW, CONSTANT, DONE = "medida_invalida", "amostra_insuficiente", "desvio_zero", "avaliado"


def check_limit(value: float, what: str) -> float:
    """A positive finite number, and no bool or text."""
    if isinstance(value, bool) or not isinstance(value, int | float) or not 0 < value < float("inf"):
        raise ValueError(f"{what} must be a positive number, not {value!r}")
    return float(value)


def describe(df: DataFrame, by: Sequence[str] = SERIES, value: str = "valor") -> DataFrame:
    """One row for each group with a valid measure: counts, mean, exact median and quartiles, sample deviation and variance.

    Quartiles are interpolated; a group of one has null deviation and variance. A
    null in a group column is an error when the result is computed.
    """
    v = finite(F.col(value).cast("double"))
    # checked in the same pass, by the rows themselves
    keys = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a null in the group column {c}")).cast(kind)) for c, kind in df.dtypes if c in by}
    rows = df.select(v.alias("_v"), *[k.alias(c) for c, k in keys.items()])
    more = [F.count("_v").alias("n_validos"), (F.count("*") - F.count("_v")).alias("n_invalidos"), F.avg("_v").alias("media"), F.stddev_samp("_v").alias("desvio_padrao"), F.var_samp("_v").alias("variancia")]
    found = exact_quantiles(rows, by, "_v", QUARTILES, ("q1", "mediana", "q3"), more).where("n_validos > 0")
    return found.select(*by, "n_validos", "n_invalidos", "media", "mediana", "desvio_padrao", "variancia", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), F.lit(1).alias("ddof"))


def z_scores(df: DataFrame, by: Sequence[str] = SERIES, value: str = "valor", limit: float = 3.0) -> DataFrame:
    """df with counts, mean, deviation, z_score, its state and whether it is an anomaly: beyond the limit, not at it.

    Score and flag are null unless the row was evaluated. Invalid measures become null.
    """
    limit = check_limit(limit, "the limit")
    rows = df.withColumn(value, finite(F.col(value).cast("double")))
    return _scored(join_groups(rows, rows.groupBy(*by).agg(*_moments(value)), by), value, limit)


def _moments(value: str) -> list[Column]:
    """What a Z-score needs of a series."""
    return [F.count(value).alias("n_validos"), F.count_if(F.col(value).isNull()).alias("n_invalidos"), F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio_padrao")]


def _scored(rows: DataFrame, value: str, limit: float) -> DataFrame:
    state = F.when(F.col(value).isNull(), INVALID).when(F.col("n_validos") < 2, FEW).when(F.col("desvio_padrao") == 0, CONSTANT).otherwise(DONE)
    rows = rows.withColumn("status_zscore", state)
    score = F.when(F.col("status_zscore") == DONE, (F.col(value) - F.col("media")) / F.col("desvio_padrao"))
    return rows.withColumns({"ddof": F.lit(1), "limiar_zscore": F.lit(limit), "z_score": score}).withColumn("anomalia_zscore", F.abs("z_score") > limit)


def iqr_flags(df: DataFrame, by: Sequence[str] = SERIES, value: str = "valor", factor: float = 1.5) -> DataFrame:
    """df with the group's quartiles and Tukey limits, and whether the measure is outside them; null for invalid measures."""
    factor = check_limit(factor, "the factor")
    rows = df.withColumn(value, finite(F.col(value).cast("double")))
    return _fenced(join_groups(rows, exact_quantiles(rows, by, value, (0.25, 0.75), ("q1", "q3")), by), value, factor)


def _fenced(rows: DataFrame, value: str, factor: float) -> DataFrame:
    rows = rows.withColumn("iqr", F.col("q3") - F.col("q1"))
    rows = rows.withColumns({"limite_inferior_iqr": F.col("q1") - factor * F.col("iqr"), "limite_superior_iqr": F.col("q3") + factor * F.col("iqr"), "fator_iqr": F.lit(factor)})
    flag = (F.col(value) < F.col("limite_inferior_iqr")) | (F.col(value) > F.col("limite_superior_iqr"))
    return rows.withColumns({"anomalia_iqr": flag, "status_iqr": F.when(F.col(value).isNull(), INVALID).otherwise(DONE)})


def either(a: Column, b: Column) -> Column:
    """a or b, where a null counts as false unless both are null."""
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))


def alerts(df: DataFrame, by: Sequence[str] = SERIES, value: str = "valor", factor: float = 1.5, limit: float = 3.0, of_series: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Both flags and their combination alerta_qualidade; what they need of a series is made in one pass and joined once.

    of_series, if given, adds other columns to the table of series, which come to the rows by the same join.
    """
    factor, limit = check_limit(factor, "the factor"), check_limit(limit, "the limit")
    rows = df.withColumn(value, finite(F.col(value).cast("double")))
    series = exact_quantiles(rows, by, value, (0.25, 0.75), ("q1", "q3"), _moments(value))
    rows = join_groups(rows, of_series(series) if of_series else series, by)
    rows = _scored(_fenced(rows, value, factor), value, limit)
    return rows.withColumn("alerta_qualidade", either(F.col("anomalia_iqr"), F.col("anomalia_zscore")))


def sql_anomalies(df: DataFrame, by: Sequence[str] = ("id_estacao", "codigo_parametro"), value: str = "valor", limit: float = 3.0, factor: float = 1.5) -> DataFrame:
    """The relational report's dialect: flags are never null, and a Z-score at the limit is an anomaly."""
    rows = df.where(F.col(value).isNotNull())
    more = [F.count("*").alias("n"), F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio"), F.var_samp(value).alias("variancia")]
    rows = join_groups(rows, exact_quantiles(rows, by, value, QUARTILES, ("q1", "mediana", "q3"), more), by)
    score = F.when(F.col("desvio") > 0, (F.col(value) - F.col("media")) / F.col("desvio"))
    low, high = (F.col("q1") - factor * (F.col("q3") - F.col("q1")), F.col("q3") + factor * (F.col("q3") - F.col("q1")))
    rows = rows.withColumns({"z_score": score, "limite_inferior": low, "limite_superior": high})
    return rows.withColumns({"anomalia_z": F.coalesce(F.abs("z_score") >= limit, F.lit(False)), "anomalia_iqr": (F.col(value) < low) | (F.col(value) > high)})


def rolling_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str = "valor", rows: int = 7, name: str = "media_movel", most: int = MOST_IN_TASK, counted: DataFrame | None = None) -> DataFrame:
    """df with the mean of this row's and the rows - 1 earlier measures of its series; invalid ones are left out.

    Where a series has more than most rows, it is cut into ranges of that many by its
    rows' places (dense_positions, which needs no task for a series), and each range
    also gets the last rows - 1 of the range before it, so that its means are whole.
    counted, if given, has the same series with as many rows, and is cheaper to count:
    what df is made by runs for the result alone.
    """
    mean = F.avg(finite(F.col(value).cast("double")))
    largest = (df if counted is None else counted).groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:
        return df.withColumn(name, mean.over(Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0)))
    placed = dense_positions(df, [F.col(c).asc_nulls_first() for c in order], by, name="_at")
    size = max(most, rows)
    own = F.floor(F.col("_at") / size)
    lent = F.col("_at") % size >= size - (rows - 1)
    ranged = placed.withColumn("_range", F.explode(F.when(lent, F.array(own, own + 1)).otherwise(F.array(own))))
    found = ranged.withColumn(name, mean.over(Window.partitionBy(*by, "_range").orderBy("_at").rowsBetween(1 - rows, 0)))
    return found.where(F.col("_range") == own).drop("_at", "_range")


def status_counts(df: DataFrame, status: str = "status_zscore") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))


def period(df: DataFrame, at: str = "data_leitura") -> tuple:
    """(first day, day after the last) of the measures, or nulls."""
    return tuple(period_of(df, at).first())


def period_of(df: DataFrame, at: str = "data_leitura") -> DataFrame:
    """(first, end): a row with the first UTC day and the day after the last."""
    return df.agg(utc_day(F.min(at)).alias("first"), F.date_add(utc_day(F.max(at)), 1).alias("end"))
