"""Versions of a table below one folder: ``<root>/version=<n>``, of which the newest complete one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierworks.sources.listing import entries, exists


def versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions of a table below ``root``, oldest first."""
    if not exists(spark, root):
        return []
    folders = [e.path for e in entries(spark, root) if e.is_dir and e.name.startswith("version=")]
    return [f for f in folders if exists(spark, f"{f}/_SUCCESS")]


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version of a table, or None before the first."""
    known = versions(spark, root)
    return spark.read.parquet(known[-1]) if known else None


def version_number(path: str) -> int:
    return int(path.rstrip("/").rsplit("=", 1)[-1])


def unfinished_versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of versions that a failed or running write has left incomplete. A report: nothing is deleted."""
    if not exists(spark, root):
        return []
    return [e.path for e in entries(spark, root) if e.is_dir and e.name.startswith("version=") and not exists(spark, f"{e.path}/_SUCCESS")]
