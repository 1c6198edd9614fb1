"""Window analytics: newest per key, top per group, group maximum and delta, running total, change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tierworks.functions import exact, newest_first, sortable
from tierworks.plans.sizing import join_per_group
from tierworks.plans.skew import OrderedGroups, by_group_size


def newest_per_key(
    df: DataFrame, key: list[str], order: list[str], *, order_is_unique: bool = False
) -> DataFrame:
    """One row per key: the newest by ``order[0]``, ties broken by the rest of ``order``.

    What is still tied is decided by the remaining columns, so the answer never depends on file order;
    say ``order_is_unique=True`` to sort by ``order`` alone. Rank and filter stand together, so Spark
    keeps one row per key and task before the shuffle, and a hot key costs no more than another.
    """
    tie = [] if order_is_unique else [
        f.name for f in df.schema if f.name not in {*key, *order} and sortable(f.dataType)
    ]
    newest = Window.partitionBy(*key).orderBy(*[newest_first(c) for c in [*order, *tie]])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def top_per_group(
    df: DataFrame,
    part: list[str],
    measure: str,
    k: int = 1,
    *,
    rank: str = "rnk",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Rows whose ``measure`` is among the ``k`` largest distinct values of their group, ties kept.

    Rank and filter stand together, so only the leading values of each task are shuffled. In a large
    group even those ties may be too many for one task: there the winning values are found first (one
    row per group and value) and the rows are matched with them where they are.
    """
    largest = Window.partitionBy(*part).orderBy(newest_first(measure))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn(rank, F.dense_rank().over(largest).cast("bigint")).filter(F.col(rank) <= k)

    def matched(rows: DataFrame) -> DataFrame:
        values = rows.select(*part, measure).distinct()
        winners = values.withColumn(rank, F.row_number().over(largest).cast("bigint"))
        return join_per_group(rows, winners.filter(F.col(rank) <= k), [*part, measure])

    return by_group_size(df, part, ranked, matched, rows_per_task)


def group_max_and_delta(
    df: DataFrame,
    part: list[str],
    measure: str,
    *,
    max_name: str = "group_max",
    delta_name: str = "delta_from_avg",
    sum_type: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add the group's maximum and the distance from its average to each row; no rows collapse.

    Large groups are aggregated and the few results broadcast, so their rows are not shuffled. ``sum_type`` (such as
    ``MONEY``) makes the average of floating values independent of row order, at that type's precision.
    """
    amount = exact(df, measure, sum_type)
    group = Window.partitionBy(*part)

    def in_window(rows: DataFrame) -> DataFrame:
        average = F.try_divide(F.sum(amount).over(group).cast("double"), F.count(measure).over(group))
        return rows.withColumns({max_name: F.max(measure).over(group), "_avg": average})

    def joined(rows: DataFrame) -> DataFrame:
        average = F.try_divide(F.sum(amount).cast("double"), F.count(measure))
        stats = rows.groupBy(*part).agg(F.max(measure).alias(max_name), average.alias("_avg"))
        return join_per_group(rows, stats, part)

    both = by_group_size(df, part, in_window, joined, rows_per_task)
    return both.withColumn(delta_name, F.col(measure) - F.col("_avg")).drop("_avg")


def running_total(
    df: DataFrame,
    part: list[str],
    order: list[str],
    measure: str,
    *,
    name: str = "running_total",
    sum_type: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Sum of ``measure`` from the first row of the group to this one (ROWS frame, NULLs last).

    ``order`` must be unique within a group; see :class:`OrderedGroups` for large groups. Values are added as they are;
    ``sum_type`` (such as ``MONEY``) adds floating values as that decimal.
    """
    ordered = OrderedGroups(df, part, order, rows_per_task)
    summed = ordered.running_sum(ordered.rows, exact(df, measure, sum_type), name)
    kind = df.schema[measure].dataType.simpleString()
    floating = kind in ("double", "float")
    return ordered.done(summed.withColumn(name, F.col(name).cast("double")) if floating else summed)


def period_change(
    df: DataFrame,
    part: list[str],
    order: list[str],
    measure: str,
    *,
    name: str = "period_change",
    rows_per_task: int | None = None,
) -> DataFrame:
    """``measure`` minus that of the previous row of the group; NULL for the first row."""
    ordered = OrderedGroups(df, part, order, rows_per_task)
    value = F.struct(F.col(measure).alias("v"))
    seen = ordered.neighbour(ordered.rows, value, "_previous")
    changed = seen.withColumn(name, F.col(measure) - F.col("_previous.v")).drop("_previous")
    return ordered.done(changed)
