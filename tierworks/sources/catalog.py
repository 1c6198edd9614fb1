"""Tables by catalog name or path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierworks.sources.versions import read_latest


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A catalog table, or the Parquet table at a path: its newest complete version, where it has versions."""
    if not is_path(target):
        return spark.table(target)
    latest = read_latest(spark, target)
    return spark.read.parquet(target) if latest is None else latest


def database_folder(spark: SparkSession, namespace: str | None) -> str:
    """Where the tables of a namespace (None: the current one) are stored."""
    return spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase()).locationUri.rstrip("/")


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """``namespace``, ``table`` for each stored table, by name."""
    return (
        spark.sql(f"SHOW TABLES IN {namespace}")
        .filter("NOT isTemporary")
        .selectExpr("namespace", "tableName AS `table`")
        .orderBy("table")
    )


def resolve(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """Upstream tables of a model: logical name to DataFrame, from logical name to table or path."""
    return {name: read_table(spark, target) for name, target in names.items()}
