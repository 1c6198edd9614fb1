"""Measure a DataFrame before deciding how to join it.

Nothing is broadcast on a guess: the table is computed once, its rows and bytes are observed while it
is written, and only a table below both bounds gets the hint. A larger one keeps its place in a
shuffled join, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tierworks.plans.workspace import settle

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Measured:
    """A settled DataFrame with its observed size."""

    df: DataFrame
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES

    def for_join(self) -> DataFrame:
        return F.broadcast(self.df) if self.small else self.df


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: 8 bytes a value, and the bytes of text, binary and nested values."""

    def width(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return 8 + F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(kind, T.StructType):
            return reduce(lambda a, b: a + b, [width(value[f.name], f.dataType) for f in kind.fields], F.lit(8))
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            return 16 + 8 * F.coalesce(F.size(value), F.lit(0))
        if isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)):
            return 16 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0))
        return F.lit(8)

    return reduce(lambda a, b: a + b, [width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], F.lit(16))


def measure(df: DataFrame) -> Measured:
    seen = Observation()
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_bytes(df)).alias("bytes"),
    )
    kept = settle(watched)
    return Measured(kept, int(seen.get["rows"]), int(seen.get["bytes"] or 0))


def same(left: list[str], right: list[str]) -> Column:
    """NULL-safe equality of two column lists; Spark plans it as a hash or sort-merge equi-join."""
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, pairs, F.lit(True))


def join_per_group(df: DataFrame, values: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Attach to each row the values of its group. ``values`` holds one row per group.

    ``values`` is measured first, so the large side is shuffled only when the groups themselves are
    too many to broadcast. NULL is a group like any other.
    """
    names = [f"_group_{i}" for i in range(len(keys))]
    renamed = values.withColumnsRenamed(dict(zip(keys, names)))
    side = measure(renamed).for_join()
    return df.join(side, same(keys, names), how).drop(*names)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is below both bounds. Nothing is kept, so use it for what is cheap to read again.

    The rows are counted first, which for a stored table needs no column; bytes are added up only for
    a table that passes.
    """
    if df.count() > BROADCAST_ROWS:
        return False
    return (df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0) <= BROADCAST_BYTES
