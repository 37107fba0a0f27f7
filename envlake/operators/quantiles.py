"""Exact quantiles of groups of any size.

percentile() holds a group's distinct values in a task's memory. Here the distinct values
of a group are counted before the shuffle and streamed in order through one task. Of a
group that is too large for that, a sketch, made before the shuffle, gives bounds a
little below and above each wanted quantile.
They cut the numbers into classes: those at a bound, and those between two. Classes are
counted, again before the shuffle, and only the class in which a wanted rank falls is
looked at by distinct value: those near a quantile, however the values are spread, and
however many outliers there are. Where a sketch is off, the rank falls in another class
and the result is still exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written

#: How far beside a quantile its bounds lie, as a share of the group, and the sketch's accuracy.
BESIDE, ACCURACY = 0.002, 4000
#: A group is large if it has more numbers than the first, and more than one in so many of all; and beyond the last in any case.
LEAST_LARGE, SHARE, MOST_IN_TASK = 64_000, 1000, 1_000_000


def same_group(by: Sequence[str], left: str, right: str):
    """Whether two aliased tables' rows have the same group; nulls are a group."""
    rule = F.lit(True)
    for c in by:
        rule = rule & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return rule


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows with the columns of their group; Spark sends the groups to the rows where they are few, and splits a large one where not."""
    extra = [c for c in groups.columns if c not in by]
    return rows.alias("l").join(groups.alias("r"), same_group(by, "l", "r"), "left").select("l.*", *[f"r.{c}" for c in extra])


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """(by, more, names): the quantiles of each group's numbers, interpolated between ranks; groups without numbers have none.

    more are other aggregates of the groups, made in one pass with their counts, which is
    written; without them groups without numbers are left out. Large groups, which would keep
    a task longer than others, are told from the rest by a join with them, if there are any.
    """
    number = F.col(value).cast("double")
    groups = written(df.groupBy(*by).agg(F.count(number).alias("_n"), *more), "groups")
    rows = df.where(number.isNotNull()).select(*by, number.alias("_v"))
    total, largest = (n or 0 for n in groups.agg(F.sum("_n"), F.max("_n")).first())
    most = min(MOST_IN_TASK, max(LEAST_LARGE, total // SHARE))
    if largest <= most:
        found = _by_value(rows, by, probabilities, names)
    else:
        large = groups.where(F.col("_n") > most).select(*by)
        part = lambda how: rows.alias("l").join(large.alias("r"), same_group(by, "l", "r"), how)
        found = _by_value(part("left_anti"), by, probabilities, names).unionByName(_by_class(part("left_semi"), by, probabilities, names))
    return join_groups(groups.drop("_n"), found, by) if more else found


def _ranked(position: Column, low: Column, high: Column) -> Column:
    """The number at a position between those of the ranks below and above."""
    return F.when(low == high, low).otherwise((F.ceil(position) - position) * low + (position - F.floor(position)) * high)


def _by_value(rows: DataFrame, by: Sequence[str], probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles by the ranks of a group's distinct numbers, which one task takes in order; equal ones are counted before the shuffle."""
    values = rows.groupBy(*by, "_v").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*by).orderBy("_v")
    values = values.withColumns({"_n": F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "_upto": F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    holds = lambda rank: (rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto"))
    ranks = [(round_((F.col("_n") - 1) * p), f"_{i}{side}") for i, p in enumerate(probabilities) for side, round_ in (("low", F.floor), ("high", F.ceil))]
    near = values.where(reduce(lambda a, b: a | b, [holds(rank) for rank, _ in ranks]))
    at = near.groupBy(*by).agg(F.first("_n").alias("_n"), *[F.max(F.when(holds(rank), F.col("_v"))).alias(name) for rank, name in ranks])
    return at.select(*by, *[_ranked((F.col("_n") - 1) * p, F.col(f"_{i}low"), F.col(f"_{i}high")).alias(name) for i, (p, name) in enumerate(zip(probabilities, names, strict=True))])


def _by_class(rows: DataFrame, by: Sequence[str], probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles of large groups by the classes that sketches give."""
    near = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-BESIDE, BESIDE)})
    bounds = F.array_sort(F.array_distinct(F.percentile_approx("_v", [float(p) for p in near], ACCURACY)))
    groups = written(rows.groupBy(*by).agg(F.count("*").alias("_n"), bounds.alias("_bounds")), "sketches")
    marked = join_groups(rows, groups, by)
    # twice the bounds below a number, and one if it is a bound
    place = F.aggregate("_bounds", F.lit(0), lambda k, b: k + (F.col("_v") > b).cast("int") + (F.col("_v") >= b).cast("int"))
    classed = marked.select(*by, "_v", "_n", place.alias("_class"))
    order = Window.partitionBy(*by).orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    held = classed.groupBy(*by, "_class").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    held = held.withColumn("_before", F.coalesce(F.sum("_c").over(order), F.lit(0)))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor((F.col("_n") - 1) * p), F.ceil((F.col("_n") - 1) * p)) for p in probabilities])))
    wanted = held.withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c"))))
    wanted = wanted.where(F.size("_ranks") > 0).select(*by, "_class", "_before", "_n", "_ranks")
    near = classed.drop("_n").alias("l").join(wanted.alias("r"), same_group([*by, "_class"], "l", "r")).select("l.*", "r._before", "r._n", "r._ranks")
    values = near.groupBy(*by, "_class", "_v").agg(F.count("*").alias("_c"), F.first("_before").alias("_base"), F.first("_n").alias("_n"), F.first("_ranks").alias("_ranks"))
    inside = Window.partitionBy(*by, "_class").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_at", F.col("_base") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    found = values.withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_c")))))
    at = found.groupBy(*by).agg(F.first("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"))
    return at.select(*by, *[_ranked((F.col("_n") - 1) * p, F.col("_m")[F.floor((F.col("_n") - 1) * p)], F.col("_m")[F.ceil((F.col("_n") - 1) * p)]).alias(name) for p, name in zip(probabilities, names, strict=True)])
