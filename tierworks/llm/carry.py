"""A table's own columns, carried through an operator under one name, so that none of them can clash with its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CARRIED = "carried"


def packed(df: DataFrame, text: str, *more: str) -> DataFrame:
    """``text`` (under this name), further columns that the operator reads, and all others in one struct."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    return df.select(F.col(f"`{text}`").alias("text"), *(F.col(f"`{c}`") for c in more), row.alias(CARRIED))


def unpacked(columns: list[str], text: str, value: Column | None = None) -> list[Column]:
    """The table's columns again, in their order; ``value`` in place of the text where it is given."""
    own = F.col("text") if value is None else value
    return [own.alias(c) if c == text else F.col(CARRIED).getField(c).alias(c) for c in columns]
