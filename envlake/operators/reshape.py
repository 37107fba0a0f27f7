"""Wide readings, long measurements, events with items, and reports that pivot them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..domain import PARAMETERS, UNKNOWN_UNIT, Contract


def long_table(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "parameter", value: str = "value") -> DataFrame:
    """One row for each row and value column."""
    return df.unpivot(list(ids), list(values), variable, value)


def code_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def measurements(readings: DataFrame, contract: Contract) -> DataFrame:
    """A dataset's readings as the long table of measures, with codes and units; missing id or measure columns are null."""
    for c in ("id_leitura_origem", *contract.numeric):
        if c not in readings.columns:
            readings = readings.withColumn(c, F.lit(None).cast("string" if c == "id_leitura_origem" else "double"))
    wide = readings.select("id_estacao", "id_leitura_origem", contract.instant, *[F.col(c).cast("double") for c in contract.numeric])
    rows = long_table(wide, ["id_estacao", "id_leitura_origem", contract.instant], contract.numeric, "_column", "valor")
    units = {code: unit for code, _, unit in PARAMETERS}
    code = code_map(contract.codes)[F.col("_column")]
    return rows.select(F.lit(contract.name).alias("dataset"), "id_estacao", code.alias("codigo_parametro"), F.coalesce(code_map(units)[code], F.lit(UNKNOWN_UNIT)).alias("unidade_medida"), "id_leitura_origem", F.col(contract.instant).alias("data_leitura"), "valor")


def items(events: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each event and value that it has."""
    return long_table(events, key, values, "code", "value").where("value is not null")


def event_rows(headers: DataFrame, items: DataFrame, key: Sequence[str], codes: Sequence[str], code: str = "code", value: str = "value") -> DataFrame:
    """One row for each header with a column for each code; events without items stay."""
    wide = items.where(F.col(code).isin(*codes)).groupBy(*key).agg(*[F.max(F.when(F.col(code) == c, F.col(value))).alias(c) for c in codes])
    return headers.join(wide, list(key), "left")


def conditional(how, codes: dict[str, str], code: str = "code", value: str = "value") -> list[Column]:
    """how (such as F.avg) of the values of each code, named as codes say."""
    return [how(F.when(F.col(code) == c, F.col(value))).alias(name) for c, name in codes.items()]
