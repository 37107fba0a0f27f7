"""Lookups, anti and semi joins, and checks of references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import match_key
from .keys import assert_unique


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(found, unmatched): rows with dim's columns, and rows whose key dim lacks. dim's key must not repeat."""
    if check:
        assert_unique(dim, on, "the dimension")
    return df.join(dim, list(on)), df.join(dim, list(on), "left_anti")


def new_rows(df: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of df whose key existing lacks; a null key is never in existing."""
    return df.join(existing.select(*key), list(key), "left_anti")


def known_rows(df: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(existing.select(*key), list(key), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of child whose reference, where it is not null, is in no row of parent; on maps child to parent columns."""
    renamed = parent.select(*[F.col(p).alias(f"_parent_{c}") for c, p in on.items()])
    condition = [F.col(c) == F.col(f"_parent_{c}") for c in on]
    given = [F.col(c).isNotNull() for c in on]
    rows = child.where(reduce(lambda a, b: a & b, given))
    return rows.join(renamed, condition, "left_anti")


def reindex(keys: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every key, with dim's columns or nulls."""
    return keys.select(*on).distinct().join(dim, list(on), "left")


def match_places(df: DataFrame, places: DataFrame, name: str, state: str, aliases: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """df joined with places on the state and the name without case, accents and punctuation.

    aliases maps (state, key) to the key that places use.
    """
    key: Column = match_key(F.col(name))
    for (uf, alias), target in (aliases or {}).items():
        key = F.when((F.upper(F.trim(state)) == uf) & (match_key(F.col(name)) == alias), F.lit(target)).otherwise(key)
    left = df.withColumn("_state", F.upper(F.trim(state))).withColumn("_place", key)
    right = places.withColumn("_state", F.upper(F.trim("state"))).withColumn("_place", match_key(F.col("place"))).drop("state", "place")
    return left.join(right, ["_state", "_place"], "left").drop("_state", "_place")


def delete_with_children(parent: DataFrame, child: DataFrame, gone: DataFrame, key: str, reference: str, cascade: bool = True) -> tuple[DataFrame, DataFrame]:
    """(parent, child) without the gone keys; children go too, or forbid it."""
    own = gone.select(F.col(key).alias("_gone")).distinct()
    hit = child.join(own, F.col(reference) == F.col("_gone"), "left_semi")
    if not cascade and not hit.isEmpty():
        raise ValueError(f"rows refer to {key} by {reference}")
    return parent.join(own, F.col(key) == F.col("_gone"), "left_anti"), child.join(own, F.col(reference) == F.col("_gone"), "left_anti")
