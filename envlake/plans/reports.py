"""Published reports of the measurements, and the star schema, from the tables by day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import CONTRACTS
from ..functions.numbers import positive_id
from ..functions.times import inclusive_days
from ..operators.keys import assert_unique
from ..operators.quality import guard, require_columns
from ..operators.reshape import measurements
from ..operators.star import star_schema
from ..operators.statistics import SERIES, alerts, describe, period, z_scores
from ..sources.tables import checked_days, has_table, read_days, write_csv, write_csv_parts, write_star

START, END = "periodo_inicio_utc", "periodo_fim_exclusivo_utc"
# The columns of the published reports, in order.
STATISTICS = (*SERIES, START, END, "n_validos", "n_invalidos", "media", "mediana", "desvio_padrao", "variancia", "q1", "q3", "iqr", "ddof")
Z_SCORES = (*SERIES, "id_leitura_origem", "data_leitura", "valor", "n_validos", "n_invalidos", "media", "desvio_padrao", "ddof", "limiar_zscore", "z_score", "anomalia_zscore", "status_zscore", START, END)
ALERTS = (*SERIES, "id_leitura_origem", "data_leitura", "valor", "q1", "q3", "iqr", "limite_inferior_iqr", "limite_superior_iqr", "anomalia_iqr", "status_iqr", "fator_iqr", "z_score", "anomalia_zscore", "status_zscore", "alerta_qualidade", START, END)
ROW_ORDER = (*SERIES, "data_leitura", "id_leitura_origem")


def read_measures(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The long table of all datasets' measures for the days from first to last, both included.

    Rows are checked as they are read: columns, ids, instants, the day of their
    folder, and natural keys, none of which may repeat. A dataset without a table
    is left out; it is an error if none has one.
    """
    if first and last:
        inclusive_days(first, last)
    start, end = (inclusive_days(d, d)[i].date() if d else None for i, d in enumerate((first, last)))
    parts = []
    for contract in CONTRACTS.values():
        path = f"{folder.rstrip('/')}/{contract.name}"
        if not has_table(spark, path):
            continue
        rows = read_days(spark, path, start, end)
        require_columns(rows, ("id_estacao", contract.instant), contract.name)
        if dict(rows.dtypes)[contract.instant] not in ("timestamp", "timestamp_ntz"):
            raise ValueError(f"{contract.name}: {contract.instant} holds no instants")
        bad_id = positive_id(F.col("id_estacao")).isNull()
        guard(rows, {"no valid id_estacao": bad_id, "no instant": F.col(contract.instant).isNull()}, contract.name)
        assert_unique(checked_days(rows, contract.instant), contract.key, contract.name)
        parts.append(measurements(rows, contract))
    if not parts:
        raise ValueError(f"{folder} has no measurements")
    return reduce(DataFrame.unionByName, parts)


def _with_period(df: DataFrame, measures: DataFrame, first: str | None, last: str | None, columns: Sequence[str]) -> DataFrame:
    start, end = inclusive_days(first, last) if first and last else period(measures)
    return df.withColumns({START: F.lit(start).cast("timestamp"), END: F.lit(end).cast("timestamp")}).select(*columns)


def statistics_report(measures: DataFrame, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Publish the statistics of every series; without a valid measure it is an error and the old file stays."""
    found = describe(measures)
    if found.isEmpty():
        raise ValueError("there is no valid measure")
    out = _with_period(found, measures, first, last, STATISTICS)
    write_csv(out, path, SERIES)
    return out


def z_score_report(measures: DataFrame, path: str, limit: float = 3.0, first: str | None = None, last: str | None = None, one_file: bool = True) -> DataFrame:
    """Publish the Z-score of every measure: one CSV file, or for many measures a folder of sorted parts."""
    found = z_scores(measures, limit=limit)
    if found.where("valor is not null").isEmpty():
        raise ValueError("there is no valid measure")
    out = _with_period(found, measures, first, last, Z_SCORES)
    (write_csv if one_file else write_csv_parts)(out, path, ROW_ORDER)
    return out


def alert_report(measures: DataFrame, path: str, factor: float = 1.5, limit: float = 3.0, first: str | None = None, last: str | None = None, one_file: bool = True) -> DataFrame:
    """Publish both flags of every measure: one CSV file, or for many measures a folder of sorted parts."""
    out = _with_period(alerts(measures, factor=factor, limit=limit), measures, first, last, ALERTS)
    (write_csv if one_file else write_csv_parts)(out, path, ROW_ORDER)
    return out


def publish_star(measures: DataFrame, registers: Sequence[DataFrame | None], folder: str, source: str | None = None, factor: float = 1.5, limit: float = 3.0) -> dict[str, DataFrame]:
    tables = star_schema(measures, *registers, factor=factor, limit=limit)
    write_star(tables, folder, source)
    return tables
