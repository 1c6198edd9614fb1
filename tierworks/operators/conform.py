"""Bronze text to typed columns, with the rows that do not fit kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

REASON = "_reject_reason"


def conform(
    df: DataFrame, types: dict[str, str], required: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): cast the columns of ``types`` and keep all others as they are.

    A row is rejected when a value cannot be cast or a required column is NULL. Rejected rows keep
    their raw values and name the columns at fault in ``_reject_reason``.
    """
    faults = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"{c}: not {t}")
        )
        for c, t in types.items()
    ]
    faults += [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in required or []]
    # concat_ws skips NULLs, so a row without faults gets the empty string.
    reason = F.concat_ws("; ", *faults) if faults else F.lit("")
    marked = df.withColumn(REASON, reason)
    good = marked.filter(F.col(REASON) == "").drop(REASON)
    good = good.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return good, marked.filter(F.col(REASON) != "")


def stringify(df: DataFrame) -> DataFrame:
    """Every column as nullable STRING."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
