"""Deduplication, key checks and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order, which should be total for a repeatable result."""
    turn = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_turn", turn).where("_turn = 1").drop("_turn")


def conflicting_keys(df: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key, n_rows, n_versions): keys whose rows differ in the values; nulls are values."""
    found = df.groupBy(*key).agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*values)).alias("n_versions"))
    return found.where("n_versions > 1")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, key: Sequence[str], what: str = "the table") -> DataFrame:
    """df, if no key repeats; else an error that names one."""
    found = duplicate_keys(df, key).limit(1).collect()
    if found:
        raise ValueError(f"{what} repeats {', '.join(f'{k}={found[0][k]}' for k in key)}")
    return df


def _placed(df: DataFrame, order: Sequence[str | Column], group: Sequence[str]) -> DataFrame:
    """df sorted by group and order over all tasks, written once with _task and _at, the place of a row in its task's.

    Equal rows, however many, are dealt over tasks.
    """
    sort = [*[F.col(c).asc_nulls_first() for c in group], *order, F.col("_tie")]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_tie")
    return written(ranged.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "placed")


def _shifted(placed: DataFrame, group: Sequence[str], parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """placed with columns of parts, which has a row for each task and group."""
    named = parts.select(F.col("_task").alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in group], *columns)
    same = F.col("_task") == F.col("_of")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return placed.join(named, same)


def dense_positions(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (), name: str = "position", rows: str | None = None) -> DataFrame:
    """df with each row's place, from 0 on, among the rows of its group in the given order, and on request their number.

    No task holds a group: rows are range-sorted over all tasks by group and order,
    each task numbers its own, and a prefix sum over the counts of (task, group), a row
    for each, shifts them. The sorted rows are written once, as another sort may deal
    them otherwise. The order should be total but for equal rows. Groups may be null.
    """
    placed = _placed(df, order, group)
    counts = written(placed.groupBy("_task", *group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first")), "counts")
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    if rows is not None:
        shift = shift.withColumn("_rows", F.sum("_n").over(Window.partitionBy(*group)))
    found = _shifted(placed, group, shift, ["_shift", *(["_rows"] if rows is not None else [])])
    return found.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name), *([F.col("_rows").alias(rows)] if rows is not None else []))


def prefix_sums(df: DataFrame, value: str, order: Sequence[str | Column], group: Sequence[str] = (), name: str = "before") -> DataFrame:
    """df with the sum of value, a whole number that is never null, over the rows before each in its group.

    As dense_positions(): a running sum in each task's part of a group, and a prefix sum
    over the sums of (task, group).
    """
    placed = _placed(df, order, group)
    sums = written(placed.groupBy("_task", *group).agg(F.sum(value).alias("_sum")), "sums")
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    inside = Window.partitionBy("_task", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    found = _shifted(placed.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0))), group, shift, ["_shift"])
    return found.select(*df.columns, (F.col("_own") + F.col("_shift")).alias(name))


def dimension_keys(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """df with a dense key from 1 on in the given order, however many rows there are."""
    found = dense_positions(df, [F.col(c).asc_nulls_first() for c in order], name=name)
    return found.withColumn(name, F.col(name) + 1)
