"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(18,2)"


def exact(df: DataFrame, column: str, as_type: str | None = MONEY) -> Column:
    """A form of ``column`` whose sum does not depend on row order.

    Floating point values are cast to ``as_type`` (a decimal); exact types and ``as_type=None`` are
    left as they are.
    """
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType, T.StringType))
    return F.col(column).cast(as_type) if floating and as_type else F.col(column)


def newest_first(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def oldest_first(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(sortable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return sortable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def ingest_instant(column: str) -> Column:
    """ISO-8601 text as a timestamp, NULL where it is not one."""
    return F.try_to_timestamp(F.col(column))
