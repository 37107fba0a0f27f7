"""Constraints as queries: Spark's tables enforce none, so they are counted before a write.

A Constraint names columns and a rule; report() counts the rows that break each of
a table's constraints, in one aggregate for the row rules and one shuffle for each
key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import orphans


@dataclass(frozen=True)
class NotNull:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    name: str
    rule: Column  # a null result counts as kept, as in SQL


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class References:
    columns: dict[str, str]  # own column -> parent's column
    parent: DataFrame


def report(df: DataFrame, constraints: Sequence[NotNull | Check | Unique | References]) -> DataFrame:
    """(constraint, broken): how many rows break each; of rows with one key, all but one break uniqueness."""
    rules: dict[str, Column] = {}
    parts: list[DataFrame] = []
    for c in constraints:
        if isinstance(c, NotNull):
            rules |= {f"not null: {name}": F.col(name).isNull() for name in c.columns}
        elif isinstance(c, Check):
            rules[f"check: {c.name}"] = ~F.coalesce(c.rule, F.lit(True))
        elif isinstance(c, Unique):
            per_key = df.groupBy(*c.columns).agg((F.count("*") - 1).alias("_more"))
            parts.append(per_key.agg(F.lit(f"unique: {', '.join(c.columns)}").alias("constraint"), F.coalesce(F.sum("_more"), F.lit(0)).alias("broken")))
        else:
            loose = orphans(df, c.parent, c.columns)
            parts.append(loose.agg(F.lit(f"references: {', '.join(c.columns)}").alias("constraint"), F.count("*").alias("broken")))
    if rules:
        counts = df.agg(*[F.count_if(r).alias(f"_{i}") for i, r in enumerate(rules.values())])
        pairs = F.array(*[F.struct(F.lit(name).alias("constraint"), F.col(f"_{i}").alias("broken")) for i, name in enumerate(rules)])
        parts.append(counts.select(F.explode(pairs).alias("p")).select("p.*"))
    return reduce(DataFrame.unionByName, parts)


def enforce(df: DataFrame, constraints: Sequence[NotNull | Check | Unique | References], what: str = "the table") -> DataFrame:
    """df, if no row breaks a constraint."""
    broken = report(df, constraints).where("broken > 0").collect()
    if broken:
        raise ValueError(f"{what}: " + "; ".join(f"{r.constraint} broken by {r.broken} rows" for r in broken))
    return df
