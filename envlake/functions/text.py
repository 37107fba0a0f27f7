"""Keys and labels made of text."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

def trimmed(c: Column) -> Column:
    """Text without surrounding blanks; null if nothing is left."""
    text = F.trim(c.cast("string"))
    return F.when(text != "", text)


def match_key(c: Column) -> Column:
    """A name as its compatible letters and digits without marks, in folded case (ß is ss).

    Names of registers are few and Spark has no normalisation of its own, so they go to Python in Arrow batches.
    """

    @F.pandas_udf("string")
    def folded(names: pd.Series) -> pd.Series:
        return names.map(lambda x: "".join(ch for ch in unicodedata.normalize("NFKD", x).casefold() if ch.isalnum()), na_action="ignore").astype(object)

    return folded(c.cast("string"))


def blank(*columns: Column) -> Column:
    """Whether any of the columns is null or, as text, blank."""
    return reduce(lambda a, b: a | b, [c.isNull() | (F.trim(c.cast("string")) == "") for c in columns])


def station_label(name: Column, description: Column, status: Column) -> Column:
    """A station's displayed name; one that is not exactly "ativa" is marked."""
    label = F.trim(F.concat(F.coalesce(name, F.lit("")), F.lit(" - "), F.coalesce(description, F.lit(""))))
    return F.when(status == "ativa", label).otherwise(F.concat(F.lit("[Desativado] "), label))


def joined_reasons(reasons: Column, separator: str = ", ") -> Column:
    return F.array_join(reasons, separator)


def safe_source(url: Column, label: Column | None = None) -> Column:
    """Where data came from, without user, password, query or fragment: host and path, or the given label."""
    shown = F.concat(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    return shown if label is None else F.coalesce(trimmed(label), shown)


def active_flag(status: Column, active: tuple[str, ...], inactive: tuple[str, ...]) -> Column:
    """1 for an active word, 0 for an inactive or unknown one, null for null."""
    word = F.lower(F.trim(status.cast("string")))
    return F.when(word.isin(*active), 1).when(word.isin(*inactive) | word.isNotNull(), 0)
