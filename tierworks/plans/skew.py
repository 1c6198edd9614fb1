"""Ordered work (running sums, previous / next row, last seen) over groups of any size.

A plain window puts a whole group into one task. That is fine until one group holds a third of the
table. :class:`OrderedGroups` looks for groups above ``rows_per_task`` and cuts each of them along its own
order into cells of about that many rows. The window then runs per group and cell, with the one shuffle
it needs anyway, and what a cell needs from the cells before it (a sum, a neighbouring row) comes from a
small table with one row per cell.

Which groups are large, and where their cells begin, is read off a sample of the key and order columns.
That decides only how the work is laid out: every row is in one cell, and the result is that of the plain
window whatever the sample holds. The order must be total within a group: give a unique column last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tierworks.functions import oldest_first
from tierworks.plans.sizing import Measured, measure, same
from tierworks.plans.workspace import settle

ROWS_PER_TASK = 5_000_000
# Rows of a group at the limit that a sample is expected to hold: the estimate is good to some 5%.
SAMPLED_AT_LIMIT = 500
# Sampled rows per cell from which the bounds of cells are chosen.
SAMPLED_PER_CELL = 20
CELL, LARGE = "_cell", "_large"


def _sampled(df: DataFrame, expected: float, rows: int) -> tuple[DataFrame, float]:
    """(a sample with ``expected`` out of every ``rows`` rows, its rate); small numbers keep all."""
    rate = min(1.0, expected / rows)
    return (df.sample(rate, seed=17) if rate < 1.0 else df), rate


def _large(points: DataFrame, keys: list[str], rows: int, rate: float) -> Measured:
    estimate = (F.count(F.lit(1)) / rate).cast("bigint")
    counts = points.groupBy(*keys).agg(estimate.alias("_group_rows"))
    return measure(counts.filter(F.col("_group_rows") > rows))


def large_groups(df: DataFrame, keys: list[str], rows: int) -> Measured:
    """Groups of more than about ``rows`` rows, with their estimated row count in ``_group_rows``.

    The sampling rate depends on ``rows`` alone, so the sample shuffles a tiny part of a huge table,
    and a table smaller than the limit yields next to nothing. There are at most
    total / ``rows`` such groups, which bounds the size of the result.
    """
    points, rate = _sampled(df.select(*keys), SAMPLED_AT_LIMIT, rows)
    return _large(points, keys, rows, rate)


def split_by_keys(df: DataFrame, keys: list[str], chosen: Measured) -> tuple[DataFrame, DataFrame]:
    """(rows of the chosen keys, all other rows); ``chosen`` has one row per key."""
    names = [f"_chosen_{i}" for i in range(len(keys))]
    side = chosen.df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    side = F.broadcast(side) if chosen.small else side
    on = same(keys, names)
    return df.join(side, on, "left_semi"), df.join(side, on, "left_anti")


def by_group_size(
    df: DataFrame,
    keys: list[str],
    calm: Callable[[DataFrame], DataFrame],
    busy: Callable[[DataFrame], DataFrame],
    rows_per_task: int | None = None,
) -> DataFrame:
    """``calm`` (one group per task will do) over the usual groups and ``busy`` over the large ones."""
    large = large_groups(df, keys, rows_per_task or ROWS_PER_TASK)
    if not large.rows:
        return calm(df)
    hot, rest = split_by_keys(df, keys, large)
    return calm(rest).unionByName(busy(hot))


def _point(order: list[str]) -> Column:
    """The order columns as one value that compares like the order itself: ascending, NULLs last."""
    pairs = [(F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")) for i, c in enumerate(order)]
    return F.struct(*[part for pair in pairs for part in pair])


def bounds_up_to(point: Column, bounds: Column, most: int) -> Column:
    """How many of the sorted ``bounds`` (``most`` at the most) are not above ``point``.

    Bisection by falling powers of two: a step is taken when the bound it would reach is not above the
    point. Steps past the end meet NULL and are not taken.
    """
    powers = F.array(*[F.lit(1 << n) for n in reversed(range(most.bit_length()))])

    def advance(at: Column, step: Column) -> Column:
        reached = at + step
        return F.when(F.get(bounds, reached - 1) <= point, reached).otherwise(at)

    return F.aggregate(powers, F.lit(0), advance)


class OrderedGroups:
    """``df`` prepared for ordered work; the prepared rows are in ``rows``.

    ``order`` names the columns to go by, ascending with NULLs last. An empty ``keys`` makes the whole
    table one group.
    """

    def __init__(
        self, df: DataFrame, keys: list[str], order: list[str], rows_per_task: int | None = None
    ):
        self.keys, self.order = list(keys), list(order)
        self.split, self.rows = False, df
        limit = rows_per_task or ROWS_PER_TASK
        points, rate = _sampled(df.select(*dict.fromkeys([*keys, *order])), SAMPLED_AT_LIMIT, limit)
        points = settle(points)
        large = _large(points, self.keys, limit, rate)
        if not large.rows:
            return
        bounds = self._bounds(points, rate, large, limit)
        most = bounds.df.agg(F.max(F.size("_bounds"))).first()[0] or 0
        if most:
            self.split = True
            self.rows = self._in_cells(df, bounds, most)

    def _bounds(self, points: DataFrame, rate: float, large: Measured, limit: int) -> Measured:
        """One row per large group: the sorted points at which its second and later cells begin."""
        fewer, _ = _sampled(points, SAMPLED_PER_CELL / rate, limit)
        hot = split_by_keys(fewer, self.keys, large)[0] if self.keys else fewer
        nth = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._sort()))
        chosen = hot.withColumn("_nth", nth).filter(F.col("_nth") % SAMPLED_PER_CELL == 0)
        sorted_points = F.array_sort(F.collect_list(_point(self.order)))
        return measure(chosen.groupBy(*self.keys).agg(sorted_points.alias("_bounds")))

    def _in_cells(self, df: DataFrame, bounds: Measured, most: int) -> DataFrame:
        names = [f"_of_{i}" for i in range(len(self.keys))]
        side = bounds.df.withColumnsRenamed(dict(zip(self.keys, names)))
        if self.keys:
            on = same(self.keys, names)
        else:
            # One row of bounds for all: a key that is always 0 makes it a hash join like the others.
            side, names = side.withColumn("_of", F.lit(0)), ["_of"]
            on = F.pmod(F.xxhash64(*self.order), F.lit(1)) == F.col("_of")
        side = F.broadcast(side) if bounds.small else side
        large = F.col("_bounds").isNotNull()
        cell = F.when(large, bounds_up_to(_point(self.order), F.col("_bounds"), most)).otherwise(F.lit(0))
        joined = df.join(side, on, "left").withColumns({CELL: cell, LARGE: large})
        return joined.drop("_bounds", *names)

    def _sort(self) -> list[Column]:
        return [oldest_first(c) for c in self.order]

    @property
    def cell_keys(self) -> list[str]:
        return [*self.keys, CELL] if self.split else self.keys

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.cell_keys).orderBy(*self._sort())

    def _upto(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _per_cell(self, df: DataFrame, value: Column) -> DataFrame:
        """``_value`` per cell of the large groups; partial aggregation keeps it off the shuffle."""
        return df.filter(F.col(LARGE)).groupBy(*self.cell_keys).agg(value.alias("_value"))

    def _attach(self, df: DataFrame, per_cell: DataFrame, carry: Column) -> DataFrame:
        """Join ``_carry``, computed over the cells of a group in order, to the rows of each cell."""
        names = [f"_at_{i}" for i in range(len(self.cell_keys))]
        carried = per_cell.select(*self.cell_keys, carry.alias("_carry"))
        side = measure(carried.withColumnsRenamed(dict(zip(self.cell_keys, names)))).for_join()
        return df.join(side, same(self.cell_keys, names), "left").drop(*names)

    def _cells(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(CELL)

    def _earlier_cells(self) -> WindowSpec:
        return self._cells().rowsBetween(Window.unboundedPreceding, -1)

    def done(self, df: DataFrame) -> DataFrame:
        """Drop the helper columns."""
        return df.drop(CELL, LARGE)

    def running_sum(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """Sum of ``value`` from the first row of the group up to this one."""
        out = df.withColumn(name, F.sum(value).over(self._upto()))
        if not self.split:
            return out
        sums = self._per_cell(df, F.sum(value))
        out = self._attach(out, sums, F.sum("_value").over(self._earlier_cells()))
        both = F.coalesce(F.col(name) + F.col("_carry"), F.col(name), F.col("_carry"))
        return out.withColumn(name, both).drop("_carry")

    def neighbour(self, df: DataFrame, value: Column, name: str, following: bool = False) -> DataFrame:
        """``value`` (a struct) of the previous or following row of the group; NULL where there is none."""
        step, nearest = (F.lead, F.min_by) if following else (F.lag, F.max_by)
        out = df.withColumn(name, step(value).over(self.window()))
        if not self.split:
            return out
        edges = self._per_cell(df, nearest(value, _point(self.order)))
        out = self._attach(out, edges, step("_value").over(self._cells()))
        # Only the row at the edge of its cell found no neighbour in it.
        return out.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")

    def last_seen(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """The latest non-NULL ``value`` of the group up to and including this row."""
        out = df.withColumn(name, F.last(value, ignorenulls=True).over(self._upto()))
        if not self.split:
            return out
        latest = F.max_by(value, F.when(value.isNotNull(), _point(self.order)))
        carry = F.last("_value", ignorenulls=True).over(self._earlier_cells())
        out = self._attach(out, self._per_cell(df, latest), carry)
        return out.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")
