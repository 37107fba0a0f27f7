"""Set-based verdicts of what new rows do to a table, without a row-at-a-time lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_decimal, outside
from .quality import any_of

INSERT, REPLAY, ENRICH, UPDATE, REJECT, REPAIR = "insert", "replay", "enrich", "update", "reject", "repair"


def classify(new: DataFrame, existing: DataFrame, key: Sequence[str], same: Sequence[str], enrich: Sequence[str] = ()) -> DataFrame:
    """new with a verdict for each row against the row of existing with the same key.

    insert: there is none; reject: a column of same differs, or one of enrich does
    and neither is null; enrich: a null column of enrich gets a value; else replay.
    Nulls are equal.
    """
    old = existing.select(*key, *[F.col(c).alias(f"_old_{c}") for c in (*same, *enrich)], F.lit(True).alias("_known"))
    differs = F.lit(False)
    for c in same:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    fills = F.lit(False)
    for c in enrich:
        differs = differs | F.coalesce(F.col(c) != F.col(f"_old_{c}"), F.lit(False))
        fills = fills | (F.col(f"_old_{c}").isNull() & F.col(c).isNotNull())
    verdict = F.when(F.col("_known").isNull(), INSERT).when(differs, REJECT).when(fills, ENRICH).otherwise(REPLAY)
    return new.join(old, list(key), "left").withColumn("verdict", verdict).select(*new.columns, "verdict")


def upsert(new: DataFrame, existing: DataFrame, key: Sequence[str], update: Sequence[str], keep_if_null: Sequence[str] = ()) -> DataFrame:
    """(key, columns, verdict): existing with changed columns updated and new keys added.

    A null in a keep_if_null column does not overwrite what is there.
    """
    a = existing.select(*key, *[F.col(c).alias(f"_old_{c}") for c in update], F.lit(True).alias("_known"))
    b = new.select(*key, *update, F.lit(True).alias("_given"))
    given, known = F.col("_given").isNotNull(), F.col("_known").isNotNull()
    value = {c: F.when(given & (F.col(c).isNotNull() if c in keep_if_null else F.lit(True)), F.col(c)).otherwise(F.col(f"_old_{c}")) for c in update}
    changed = F.lit(False)
    for c in update:
        changed = changed | ~value[c].eqNullSafe(F.col(f"_old_{c}"))
    verdict = F.when(~known, INSERT).when(given & changed, UPDATE).otherwise(REPLAY)
    return a.join(b, list(key), "full").select(*key, *[v.alias(c) for c, v in value.items()], verdict.alias("verdict"))


def no_names() -> Column:
    return F.array().cast("array<string>")


def names_of(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold for a row, in order; a null rule does not. The list is only made where one holds."""
    held = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    return F.when(any_of(list(held.values())), F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in held.items()]), lambda x: x.isNotNull())).otherwise(no_names())


def item_rules(code: Column, number: Column, text: Column, limits: dict[str, tuple[float | None, float | None]], value: Column | None = None, most: int = 200) -> dict[str, Column]:
    """What can be wrong with an item, by reason; value is its number as an exact decimal, where that is known."""
    value = exact_decimal(number) if value is None else value
    beyond = F.lit(False)
    for c, (low, high) in limits.items():
        beyond = beyond | ((code == c) & outside(value.cast("double"), low, high))
    rules = {
        "no value": number.isNull() & text.isNull(),
        "two values": number.isNotNull() & text.isNotNull(),
        "not an exact number": number.isNotNull() & value.isNull(),
        "out of range": beyond,
        "blank text": text.isNotNull() & (F.trim(text) == ""),
        "text too long": F.length(text) > most,
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def item_reasons(code: Column, number: Column, text: Column, limits: dict[str, tuple[float | None, float | None]], most: int = 200) -> Column:
    """Why an item of an event is not acceptable; an empty list if it is.

    It has a number or a text, not both; a number fits decimal(18,6) without
    rounding and its code's limits; a text is not blank and not too long.
    """
    return names_of(item_rules(code, number, text, limits, most=most))


def code_sets(items: DataFrame, key: Sequence[str], code: str = "code") -> DataFrame:
    """(key, codes): the sorted distinct codes of each event."""
    return items.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(code)), ",").alias("codes"))


def event_verdicts(items: DataFrame, existing: DataFrame, key: Sequence[str], code: str = "code", value: str = "value") -> DataFrame:
    """(key, verdict) of whole events: insert if the event is new, replay if codes and values are the same, else reject.

    Of several versions of an event in one batch, give the first alone.
    """
    new = items.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct(code, value))).alias("_new"))
    old = existing.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct(code, value))).alias("_old"))
    verdict = F.when(F.col("_old").isNull(), INSERT).when(F.col("_old") == F.col("_new"), REPLAY).otherwise(REJECT)
    return new.join(old, list(key), "left").select(*key, verdict.alias("verdict"))


def differences(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of a that b lacks, rows of b that a lacks), counting repeats."""
    common = [c for c in a.columns if c in b.columns]
    return a.select(*common).exceptAll(b.select(*common)), b.select(*common).exceptAll(a.select(*common))
