"""Summary of benchmark runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.plans.sizing import join_per_group
from tierworks.plans.skew import OrderedGroups, by_group_size
from tierworks.plans.workspace import settle


# A group's exact median is held in one buffer up to this many rows.
ROWS_PER_BUFFER = 1_000_000


def medians_by(
    df: DataFrame, keys: list[str], values: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """Exact medians per group, under the names of the ``values``; with an even count the mean of the two
    middle values. NULLs do not count.

    Usual groups go through the built-in aggregate. It keeps all distinct values of a group, so large
    groups go through the row counts of their values in order instead.
    """

    def built_in(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.median(v).alias(v) for v in values])

    def by_counts(rows: DataFrame) -> DataFrame:
        long = rows.select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
        long = long.unpivot(keys, values, "_name", "_of").filter("_of IS NOT NULL")
        of = [*keys, "_name"]
        # Settled, as it is read several times below.
        counts = settle(long.groupBy(*of, "_of").agg(F.count(F.lit(1)).alias("_n")))
        ordered = OrderedGroups(counts, of, ["_of"], rows_per_task)
        upto = ordered.running_sum(ordered.rows, F.col("_n"), "_upto")
        totals = counts.groupBy(*of).agg(F.sum("_n").alias("_total"))

        def at(position: str) -> Column:
            return F.min(F.when(F.col("_upto") >= F.expr(position), F.col("_of")))

        middle = (at("(_total + 1) div 2") + at("_total div 2 + 1")) / 2
        found = join_per_group(upto, totals, of).groupBy(*of).agg(middle.alias("_mid"))
        wide = found.groupBy(*keys).agg(
            *[F.max(F.when(F.col("_name") == v, F.col("_mid"))).alias(v) for v in values]
        )
        # A group without any value is a group still, as in the built-in way.
        return join_per_group(rows.select(*keys).distinct(), wide, keys, "left")

    return by_group_size(df, keys, built_in, by_counts, rows_per_task or ROWS_PER_BUFFER)


def benchmark_summary(runs: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """One row per implementation, fastest first.

    The first run by file name is a warm-up and is dropped when there are more. The medians of both
    clocks, CPU and memory are taken over the rest; throughput is per work clock (without start-up),
    CPU per whole-process clock. A clock of zero gives zero.
    """
    cpu = F.coalesce("resources.user_cpu_ms", F.lit(0.0)) + F.coalesce("resources.sys_cpu_ms", F.lit(0.0))
    flat = runs.select(
        "impl",
        "file_name",
        F.col("totals.rows").alias("rows"),
        F.col("totals.wall_ms_excl_startup").alias("work_ms"),
        F.col("totals.wall_ms_incl_startup").alias("wall_ms"),
        cpu.alias("cpu_ms"),
        F.coalesce("resources.peak_rss_mb", F.lit(0.0)).alias("rss_mb"),
    )
    first = flat.groupBy("impl").agg(
        F.min("file_name").alias("_warm_up"), F.count(F.lit(1)).alias("_total")
    )
    timed = join_per_group(flat, first, ["impl"]).filter(
        (F.col("_total") == 1) | (F.col("file_name") != F.col("_warm_up"))
    )
    heads = timed.groupBy("impl").agg(
        F.min_by("rows", "file_name").alias("rows"),
        F.count(F.lit(1)).alias("kept_runs"),
        F.max("_total").alias("total_runs"),
    )
    medians = medians_by(timed, ["impl"], ["work_ms", "wall_ms", "cpu_ms", "rss_mb"], rows_per_task)

    def per(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    return (
        join_per_group(heads, medians, ["impl"])
        .withColumn("rows_per_sec", per(F.col("rows"), F.col("work_ms") / 1000))
        .withColumn("cpu_per_wall", per(F.col("cpu_ms"), F.col("wall_ms")))
        .select(
            "impl", "wall_ms", "work_ms", "rows_per_sec", "cpu_ms", "cpu_per_wall",
            "rss_mb", "rows", "kept_runs", "total_runs",
        )
        .orderBy("wall_ms", "impl")
    )
