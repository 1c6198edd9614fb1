"""The landing contract: three columns that every landed row carries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.functions import oldest_first

CONTRACT = ("_source", "_batch_id", "_ingested_at")


def with_contract(
    df: DataFrame, source: str, batch_id: str | Column, ingested_at: str | Column
) -> DataFrame:
    """Stamp rows with their source, batch and time of arrival.

    A column in place of text lets a caller backdate rows one by one. (``F.lit`` passes columns on.)
    """
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_ingested_at": F.lit(ingested_at),
            "_batch_id": F.lit(batch_id),
        }
    )


def contract_projection(df: DataFrame, n: int) -> DataFrame:
    """The contract columns of the first ``n`` rows in contract order, so the sample is repeatable."""
    return df.select(*CONTRACT).orderBy(*[oldest_first(c) for c in CONTRACT]).limit(n)


def contract_check(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per source: ``missing`` contract columns and ``null_rows`` with a NULL in the others."""

    def check(name: str, df: DataFrame) -> DataFrame:
        missing = [c for c in CONTRACT if c not in df.columns]
        holes = [F.col(c).isNull() for c in CONTRACT if c not in missing]
        any_hole = reduce(lambda a, b: a | b, holes, F.lit(False))
        return df.agg(F.count_if(any_hole).alias("null_rows")).select(
            F.lit(name).alias("source"), F.lit(",".join(missing)).alias("missing"), "null_rows"
        )

    checks = [check(name, df) for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, checks)
