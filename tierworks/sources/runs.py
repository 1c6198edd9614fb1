"""Benchmark run records: one nested JSON document per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.sources.listing import entries

RUN_SCHEMA = """
  impl STRING, run_id STRING, started_at STRING, sources ARRAY<STRING>,
  totals STRUCT<wall_ms_excl_startup: DOUBLE, wall_ms_incl_startup: DOUBLE,
                rows: BIGINT, bytes_parquet: BIGINT>,
  per_source ARRAY<STRUCT<source: STRING, read_ms: DOUBLE, parquet_write_ms: DOUBLE,
                          iceberg_commit_ms: DOUBLE, rows: BIGINT, bytes_parquet: BIGINT>>,
  notes STRING,
  resources STRUCT<peak_rss_mb: DOUBLE, user_cpu_ms: DOUBLE, sys_cpu_ms: DOUBLE>
"""


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a folder's files, with its file and, where it is no run record, its text.

    The reader only looks at columns that a query asks for, so a value of a wrong type would go unseen where its column
    is not wanted. The verdict therefore asks for all of them.
    """
    read = (
        spark.read.schema(f"{RUN_SCHEMA}, _unreadable STRING")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_unreadable")
        .option("pathGlobFilter", "*.json")
        .json(folder)
    )
    whole = F.to_json(F.struct(*(c for c in read.columns if c != "_unreadable"))).isNotNull()
    return read.withColumns({
        "_unreadable": F.when(whole, F.col("_unreadable")),
        "file_name": F.col("_metadata.file_name"),
        "_path": F.col("_metadata.file_path"),
    })


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All readable records of a folder with their ``file_name``; see :func:`run_files` for the files left out."""
    return (
        _parsed(spark, folder)
        .filter("_unreadable IS NULL")
        .drop("_unreadable", "_path")
        .withColumn("impl", F.coalesce("impl", F.lit("unknown")))
    )


def run_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.json`` file of a folder: ``file_name``, ``file_bytes``, ``records`` (readable ones), ``reason``.

    ``reason`` is NULL where all is well, else ``empty`` (no bytes), ``no record`` (only white space or an empty list),
    ``malformed`` (no JSON, or a value of another type than the record's) or ``no totals`` (a record that no summary can use). The
    listing is the left side, so a file that yields nothing is there too. Spark's own listings pass over files without bytes;
    their names come from the file system.
    """
    found = _parsed(spark, folder).groupBy("_path").agg(
        F.count_if(F.col("_unreadable").isNull()).alias("records"),
        F.count_if(F.col("_unreadable").isNotNull()).alias("_bad"),
        F.count_if(F.col("_unreadable").isNull() & F.col("totals.wall_ms_excl_startup").isNull()).alias("_bare"),
    )
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(folder)
        .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name"), F.col("length").alias("file_bytes"))
    )
    hollow = [(e.path, e.name, 0) for e in entries(spark, folder) if not e.is_dir and not e.size and e.name.endswith(".json")]
    listed = listed.unionByName(spark.createDataFrame(hollow, "_path string, file_name string, file_bytes bigint"))
    reason = (
        F.when(F.col("file_bytes") == 0, "empty")
        .when(F.col("_bad") > 0, "malformed")
        .when(F.coalesce("records", F.lit(0)) == 0, "no record")
        .when(F.col("_bare") > 0, "no totals")
    )
    return listed.join(found, "_path", "left").select(
        "file_name", "file_bytes", F.coalesce("records", F.lit(0)).alias("records"), reason.alias("reason")
    )
