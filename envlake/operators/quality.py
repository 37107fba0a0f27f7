"""Rules, reasons, quality dimensions and the split into accepted and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..domain import Contract
from ..functions.numbers import infinite, number, outside
from ..functions.text import blank
from ..functions.times import instant

#: The dimensions in which rows are counted.
DIMENSIONS = ("completeness", "uniqueness", "accuracy", "validity", "timeliness", "consistency")


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def reasons(rules: dict[str, Column]) -> Column:
    """The names of all rules that hold for a row, in order."""
    return F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())


def with_reasons(df: DataFrame, rules: dict[str, Column], column: str = "reasons") -> DataFrame:
    return df.withColumn(column, reasons(rules))


def split(df: DataFrame, rules: dict[str, Column], column: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows that break no rule, and those that do with their reasons."""
    marked = with_reasons(df, rules, column)
    return marked.where(F.size(column) == 0).drop(column), marked.where(F.size(column) > 0)


def reason_counts(rejected: DataFrame, column: str = "reasons") -> DataFrame:
    """(reason, n): how many rows each reason rejected; a row counts for each of its reasons."""
    return rejected.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "the table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")


def typed(df: DataFrame, contract: Contract) -> DataFrame:
    """df with the contract's numbers and instant coerced; what can't be read is null."""
    require_columns(df, contract.required, contract.name)
    kinds = dict(df.dtypes)
    columns = {c: (F.when(~F.isnan(c), F.col(c).cast("double")) if kinds[c] in ("double", "float") else number(F.col(c))) for c in contract.numeric}
    if kinds[contract.instant] == "string":
        columns[contract.instant] = instant(F.col(contract.instant))
    return df.withColumns(columns)


def masks(contract: Contract, kinds: dict[str, str]) -> dict[str, Column]:
    """For each dimension but uniqueness, whether a typed row fails it; a row can fail several.

    kinds has the type of each column: only texts can be blank.
    """
    empty = lambda names: any_of([blank(F.col(c)) if kinds[c] == "string" else F.col(c).isNull() for c in names])
    beyond = {c: outside(F.col(c), *contract.limit(c)) for c in contract.numeric}
    wrong = [beyond[c] for c in contract.numeric if c not in contract.accuracy] + [infinite(F.col(c)) for c in contract.numeric]
    return {
        "completeness": empty(contract.required),
        "accuracy": any_of([beyond[c] for c in contract.accuracy]),
        "validity": any_of(wrong),
        "timeliness": F.col(contract.instant).isNull(),
        "consistency": empty(contract.references),
    }


def assess(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(clean rows, counts): typed rows that pass every dimension, and one row of rejections by dimension.

    Counts are over all received rows, in one aggregate.
    """
    rows = typed(df, contract)
    fails = masks(contract, dict(rows.dtypes))
    counts = rows.agg(F.count("*").alias("received"), *[F.count_if(m).alias(name) for name, m in fails.items()])
    return rows.where(~any_of(list(fails.values()))), counts


def dimension_counts(counts: DataFrame, unique: tuple[int, int] = (0, 0)) -> DataFrame:
    """(dimension, evaluated, approved, rejected) from assess()'s counts and uniqueness's (evaluated, approved)."""
    one = [F.struct(F.lit(d).alias("dimension"), F.col("received").alias("evaluated"), (F.col("received") - F.col(d)).alias("approved"), F.col(d).alias("rejected")) for d in DIMENSIONS if d != "uniqueness"]
    evaluated, approved = (F.lit(int(x)).cast("bigint") for x in unique)
    one.append(F.struct(F.lit("uniqueness").alias("dimension"), evaluated.alias("evaluated"), approved.alias("approved"), (evaluated - approved).alias("rejected")))
    return counts.select(F.explode(F.array(*one)).alias("d")).select("d.*")


def row_rules(contract: Contract, columns: Sequence[str]) -> dict[str, Column]:
    """What can be wrong with a parsed row, by reason: given columns that are missing, then numbers out of range or infinite."""
    missing = {f"{c}: missing": blank(F.col(c)) for c in columns if c not in contract.numeric}
    missing |= {f"{c}: missing or no number": F.col(c).isNull() for c in contract.numeric if c in columns}
    return missing | {f"{c}: out of range": outside(F.col(c), *contract.limit(c)) | infinite(F.col(c)) for c in contract.numeric}


def guard(df: DataFrame, rules: dict[str, Column], what: str = "the table") -> None:
    """Raise if any row breaks a rule, naming the rules and how many rows break each."""
    found = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()]).first().asDict()
    broken = {name: n for name, n in found.items() if n}
    if broken:
        raise ValueError(f"{what}: " + ", ".join(f"{name} in {n} rows" for name, n in broken.items()))
