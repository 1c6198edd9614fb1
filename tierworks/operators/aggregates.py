"""Fact-to-dimension revenue, rank and share of total, row counts and the batch audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.functions import MONEY, exact, newest_first, oldest_first
from tierworks.plans.sizing import fits_broadcast, join_per_group, measure
from tierworks.plans.skew import OrderedGroups
from tierworks.plans.workspace import settle

# A window over the whole table runs in one task; above this many rows it is computed in cells.
ONE_TASK_ROWS = 100_000


def current_rows(dim: DataFrame) -> Column:
    """Condition for the version in force now, for either naming of the validity columns."""
    if "is_current" in dim.columns:
        return F.col("is_current")
    for name in ("effective_to", "dbt_valid_to"):
        if name in dim.columns:
            return F.col(name).isNull()
    raise ValueError("no validity column: expected is_current, effective_to or dbt_valid_to")


def revenue_by(
    fact: DataFrame,
    dim: DataFrame,
    by: str,
    current_only: bool = True,
    where: Column | None = None,
    *,
    fact_key: str = "customer_id",
    dim_key: str = "id",
    amount: str = "amount",
    fact_where: Column | None = None,
    sum_type: str | None = MONEY,
) -> DataFrame:
    """``by``, ``revenue``: the amounts of the fact summed over an attribute of the dimension.

    ``where`` filters the dimension, ``fact_where`` the fact. With ``current_only=False`` an amount
    counts once per version of its key.

    A dimension that is measured to be small is broadcast, so the fact is never shuffled. Otherwise
    the fact is summed per key before the join; a key with a third of all rows then reaches the join
    as one row.
    """
    versions = dim.filter(current_rows(dim)) if current_only else dim
    versions = versions.filter(where) if where is not None else versions
    versions = versions.select(F.col(dim_key).alias("_key"), F.col(by)).filter("_key IS NOT NULL")

    facts = fact.filter(fact_where) if fact_where is not None else fact
    facts = facts.select(F.col(fact_key).alias("_fact_key"), exact(facts, amount, sum_type).alias("_amount"))
    facts = facts.filter("_fact_key IS NOT NULL")

    if fits_broadcast(versions):
        side = F.broadcast(versions)
    else:
        side = versions
        facts = facts.groupBy("_fact_key").agg(F.sum("_amount").alias("_amount"))
    joined = facts.join(side, F.col("_fact_key") == F.col("_key"), "inner")
    return joined.groupBy(by).agg(F.sum("_amount").cast("double").alias("revenue"))


def with_rank_and_share(
    df: DataFrame,
    measure_col: str,
    places: int = 9,
    *,
    rank: str = "revenue_rank",
    share: str = "revenue_share",
    one_task_rows: int | None = None,
    sum_type: str | None = None,
) -> DataFrame:
    """Add the rank by ``measure_col`` (largest first, gaps after ties) and the share of the total.

    Meant for the few rows left by an aggregate. The rows are counted, and a larger table is ranked
    through the row counts of its distinct values, so that neither the table nor a block of ties is
    gathered in one task. Ranks are the same either way: NaN before all numbers, NULL behind them. Pass
    ``sum_type=MONEY`` for a total of money that does not hang on row order.
    """
    limit = one_task_rows or ONE_TASK_ROWS
    kept = measure(df)
    amount = exact(df, measure_col, sum_type)
    if kept.rows <= limit:
        ranked = kept.df.withColumn(
            rank, F.rank().over(Window.orderBy(newest_first(measure_col))).cast("bigint")
        )
        total = F.sum(amount).over(Window.partitionBy())
    else:
        counts = settle(kept.df.groupBy(measure_col).agg(F.count(F.lit(1)).alias("_n")))
        known = counts.filter(F.col(measure_col).isNotNull())
        rows, value = known.agg(F.sum("_n"), F.sum(exact(known, measure_col, sum_type) * F.col("_n"))).first()
        # Ascending has NaN last and NULL behind it: from the top, NaN is first and NULL last, as in a window.
        ordered = OrderedGroups(counts, [], [measure_col], limit)
        upto = ordered.running_sum(ordered.rows, F.col("_n"), "_upto")
        larger = F.when(F.col(measure_col).isNull(), F.lit(rows or 0)).otherwise(F.lit(rows or 0) - F.col("_upto"))
        ranked = join_per_group(kept.df, upto.select(measure_col, (larger + 1).cast("bigint").alias(rank)), [measure_col])
        total = F.lit(value)
    part = F.try_divide(F.col(measure_col).cast("double"), total.cast("double"))
    return ranked.withColumn(share, F.round(part, places))


def rows_by(df: DataFrame, by: list[str]) -> DataFrame:
    """Row count per group as ``count``; with an empty ``by`` the count of all rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def batch_audit(df: DataFrame, batch_col: str = "_batch_id", ts_col: str = "_ingested_at") -> DataFrame:
    """One row per batch, oldest first: ``rows``, ``earliest``, ``latest``."""
    return (
        df.groupBy(batch_col)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(ts_col).alias("earliest"),
            F.max(ts_col).alias("latest"),
        )
        .orderBy(oldest_first("earliest"), oldest_first(batch_col))
    )
