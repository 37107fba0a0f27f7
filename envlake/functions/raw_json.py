"""Checks of raw JSON values that keep their type."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import instant


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for each row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def value_at(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "variant")


def kind_of(value: Column) -> Column:
    """The JSON type of a variant: text, number, boolean, object, array, or null if there is none.

    Only scalars are asked for their schema: of a list or object it would be made of all that it holds.
    """
    scalar = let(F.schema_of_variant(value), lambda tag: F.when(tag == "VOID", None).when(tag == "STRING", "text").when(tag == "BOOLEAN", "boolean").otherwise("number"))
    return (
        F.when(value.isNull(), None)
        .when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), "array")
        .when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), "object")
        .otherwise(scalar)
    )


def kind(record: Column, path: str) -> Column:
    """The JSON type at a dotted path, as kind_of()."""
    return let(value_at(record, path), kind_of)


def extracted(record: Column, paths: Sequence[str]) -> Column:
    """A struct with v and kind for each path, in order (f0, f1, ...): every path is read once."""
    return F.struct(*[let(value_at(record, p), lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind"))).alias(f"f{i}") for i, p in enumerate(paths)])


def text_at(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


def violation(path: str, needed: str, found: Column) -> Column:
    """Why the field (v, kind) at path is not what is needed (text, number or instant), or null if it is."""
    what = found["kind"]
    if needed == "number":
        bad = let(F.try_variant_get(found["v"], "$", "double"), lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        return F.when(what.isNull(), f"{path}: missing").when(what != "number", f"{path}: not a number").when(bad, f"{path}: not finite")
    text = F.trim(F.try_variant_get(found["v"], "$", "string"))
    checked = F.when(what.isNull(), f"{path}: missing").when(what != "text", f"{path}: not a text").when(text == "", f"{path}: blank")
    if needed == "instant":
        late = F.when(instant(text, need_offset=True).isNotNull(), None).when(instant(text).isNull(), f"{path}: not an ISO instant").otherwise(f"{path}: without a time zone")
        return checked.otherwise(late)
    return checked


def first_violation(record: Column, fields: list[tuple[str, str]]) -> Column:
    """The reason of the first field, in order, that breaks its contract; null if none does."""
    return let(record, lambda r: _first_violation(r, fields))


def _first_violation(record: Column, fields: list[tuple[str, str]]) -> Column:
    known = F.try_variant_get(record, "$", "map<string,variant>").isNotNull()
    reasons = let(extracted(record, [p for p, _ in fields]), lambda x: F.coalesce(*[violation(p, n, x[f"f{i}"]) for i, (p, n) in enumerate(fields)]))
    return F.when(record.isNull() | ~known, "record: not an object").otherwise(reasons)
