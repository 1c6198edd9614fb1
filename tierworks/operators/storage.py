"""Reports on stored files: inventory, orphans, bytes and encodings per column, layout comparison."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierworks.sources.files import FILES_AT_ONCE
from tierworks.plans.workspace import settle
from tierworks.sources.listing import arrow_file, exists, parquet_files

# Where a stream sink keeps its commits, and a pattern for everything else in its folder
# (names with an underscore are Spark's own, but for folders of a partition column).
COMMIT_LOG = "_spark_metadata"
ANY_CHILD = "{[!_.]*,_*=*}"

FOOTER_SCHEMA = (
    "path string, row_group int, column string, codec string, encodings string, "
    "values bigint, compressed_bytes bigint"
)
# Three layouts of the same rows. Version 2 of the format, with the dictionary out of
# the way, is what makes the writer choose delta encodings.
LAYOUTS = {
    "defaults": {"compression": "zstd"},
    "no-dict": {"compression": "zstd", "parquet.enable.dictionary": "false"},
    "delta-text": {
        "compression": "zstd",
        "parquet.enable.dictionary": "false",
        "parquet.writer.version": "PARQUET_2_0",
    },
}


def file_inventory(spark: SparkSession, path: str, small_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """``file_path``, ``file_bytes``, ``records``, ``is_small`` per data file; files without rows have 0 records.

    No data column is read, so the scan touches footers only.
    """
    counts = (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file_path"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        parquet_files(spark, path)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_bytes"))
        .join(counts, "file_path", "left")
        .select("file_path", "file_bytes", F.coalesce("n", F.lit(0)).alias("records"))
        .withColumn("is_small", F.col("file_bytes") < small_bytes)
    )


def batch_history(spark: SparkSession, path: str, batch_col: str) -> DataFrame:
    """One row per batch of a stored table in order of arrival: rows, files, and when they were written.

    ``batch_col`` is the column (or folder level) that names the batch of a row.
    """
    per_file = (
        spark.read.parquet(path)
        .select(
            batch_col,
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("written"),
        )
        .groupBy(batch_col, "file_path")
        .agg(F.count(F.lit(1)).alias("n"), F.max("written").alias("written"))
    )
    return (
        per_file.groupBy(batch_col)
        .agg(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("files"),
            F.min("written").alias("first_written"),
            F.max("written").alias("last_written"),
        )
        .orderBy("first_written", batch_col)
    )


def orphan_files(spark: SparkSession, path: str, older_than_days: int, now: datetime | Column) -> DataFrame:
    """Data files below a stream sink's folder that no commit names and that are older than N days.

    Loading the folder lists what the sink committed; loading it by pattern, all levels included, lists what is
    there. A folder without a commit log cannot tell which files count, and is an error. A report only:
    nothing is deleted.
    """
    root = path.rstrip("/")
    if not exists(spark, f"{root}/{COMMIT_LOG}"):
        raise ValueError(f"{path} has no {COMMIT_LOG}: only a stream sink's folder names its committed files")
    moment = now if isinstance(now, Column) else F.lit(now)
    committed = spark.read.format("binaryFile").load(root).select("path")
    there = parquet_files(spark, f"{root}/{ANY_CHILD}")
    return there.join(committed, "path", "left_anti").filter(
        F.col("modificationTime") < moment - F.make_dt_interval(F.lit(older_than_days))
    )


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for uri in batch["path"]:
            fs, path = arrow_file(uri)
            with fs.open_input_file(path) as raw:
                meta = pq.ParquetFile(raw).metadata
            for group in range(meta.num_row_groups):
                chunks = meta.row_group(group)
                for i in range(chunks.num_columns):
                    c = chunks.column(i)
                    rows.append(
                        (uri, group, c.path_in_schema, c.compression, ",".join(sorted(c.encodings)),
                         c.num_values, c.total_compressed_size)
                    )
        names = [part.split()[0] for part in FOOTER_SCHEMA.split(", ")]
        yield pd.DataFrame(rows, columns=names)


def column_storage(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per file, row group and column: codec, encodings, values, compressed bytes.

    ``files`` has the paths in ``path``. The tasks read footers only; column data is not touched. The
    paths are spread over a few tasks per core, as a list of paths is too small for Spark to split.
    """
    tasks = FILES_AT_ONCE * spark.sparkContext.defaultParallelism
    return files.select("path").repartition(tasks).mapInPandas(_footers, FOOTER_SCHEMA)


def write_variant(df: DataFrame, path: str, variant: str) -> None:
    """Write ``df`` in one of the ``LAYOUTS``."""
    df.write.options(**LAYOUTS[variant]).mode("errorifexists").parquet(path)


def layout_report(spark: SparkSession, df: DataFrame, base: str) -> DataFrame:
    """Write ``df`` below ``base`` in each layout; the column storage of all, with ``variant``."""
    rows = settle(df)  # all variants hold the same rows
    for variant in LAYOUTS:
        write_variant(rows, f"{base}/{variant}", variant)
    reports = [
        column_storage(spark, parquet_files(spark, f"{base}/{v}")).withColumn("variant", F.lit(v))
        for v in LAYOUTS
    ]
    return reduce(DataFrame.unionByName, reports)


def bytes_per_column(report: DataFrame) -> DataFrame:
    """``variant``, ``column``, ``bytes`` over all files and row groups."""
    return report.groupBy("variant", "column").agg(F.sum("compressed_bytes").alias("bytes"))


def best_variant(report: DataFrame, baseline: str = "defaults") -> DataFrame:
    """Per column: bytes in each layout, the smallest one, and its share of the baseline layout.

    One row per column of the table, so the share's window over all rows stays small.
    """
    sizes = bytes_per_column(report)
    per_layout = [
        F.max(F.when(F.col("variant") == v, F.col("bytes"))).alias(v.replace("-", "_")) for v in LAYOUTS
    ]
    base = baseline.replace("-", "_")
    total = F.sum(base).over(Window.partitionBy())
    return (
        sizes.groupBy("column")
        .agg(*per_layout, F.min_by("variant", F.struct("bytes", "variant")).alias("best"))
        .withColumn("baseline_share", F.try_divide(F.col(base), total))
    )


def layout_totals(report: DataFrame, baseline: str = "defaults") -> DataFrame:
    """``variant``, ``bytes`` and the difference to the baseline layout."""
    totals = report.groupBy("variant").agg(F.sum("compressed_bytes").alias("bytes"))
    base = F.max(F.when(F.col("variant") == baseline, F.col("bytes"))).over(Window.partitionBy())
    return totals.withColumn("against_baseline", F.col("bytes") - base)
