"""Keeping tables healthy: compaction, re-partitioning, retention. Results go to new locations or come back as
DataFrames and nothing is deleted, but for ``compact_small_files``, which replaces small files where they are."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from tierworks.operators.storage import COMMIT_LOG
from tierworks.sources.listing import delete_folder, exists, move_file, parquet_files, qualified, read_text, write_text

SMALL_FILE_COST = 64 * 1024
# Fixed value: the note of a replacement under way.
COMPACTION_NOTE = "_compaction.json"


def _rewrite(df: DataFrame, dst: str, partition_by: list[str]) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.mode("errorifexists").save(dst)
    return int(seen.get["rows"])


def _whole(spark: SparkSession, src: str) -> DataFrame:
    """A table with all columns that any of its files has; files without one give NULL."""
    return spark.read.option("mergeSchema", True).parquet(src)


def _verified(spark: SparkSession, src: str, dst: str, written: int) -> DataFrame:
    result, source = spark.read.parquet(dst), _whole(spark, src)
    expected, stored = source.count(), result.count()
    if not expected == written == stored:
        raise RuntimeError(f"{dst}: {expected} rows read, {written} written, {stored} stored")
    if set(source.columns) != set(result.columns):
        raise RuntimeError(f"{dst}: columns {sorted(result.columns)} instead of {sorted(source.columns)}")
    return result


def _file_session(spark: SparkSession, file_bytes: int) -> SparkSession:
    """A session of the same application whose scans pack ``file_bytes`` of input into a task."""
    own = spark.newSession()
    for name, value in {
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
        "spark.sql.files.maxPartitionBytes": file_bytes,
        "spark.sql.files.minPartitionNum": 1,
        "spark.sql.files.openCostInBytes": SMALL_FILE_COST,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": file_bytes,
        # Values in folder names are carried over as they are written.
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }.items():
        own.conf.set(name, value)
    return own


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    target_bytes: int = 512 * 1024 * 1024,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Rewrite a Parquet table into files of about ``target_bytes`` and return the new table.

    Without partition columns there is no shuffle: the scan packs small files into tasks of the target
    size and each task writes one file. With them the rows are rebalanced on the partition columns;
    adaptive execution splits large values and joins small ones. Row counts are compared afterwards.
    """
    own = _file_session(spark, target_bytes)
    df = _whole(own, src)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    written = _rewrite(df, dst, partition_by or [])
    return _verified(spark, src, dst, written)


def small_file_groups(spark: SparkSession, path: str, small_bytes: int, target_bytes: int) -> DataFrame:
    """``folder``, ``bin``, ``path``, ``length`` of the files below ``small_bytes`` that have company.

    The running sum of the lengths in a folder, in order of names, cuts them into bins of ``target_bytes``. A file
    that is alone in its bin would only be copied, so it is left out. Reads a listing, no file is opened.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    small = parquet_files(spark, path).filter(F.col("length") < small_bytes).select(folder.alias("folder"), "path", "length")
    upto = F.sum("length").over(Window.partitionBy("folder").orderBy("path")) - F.col("length")
    binned = small.withColumn("bin", F.floor(upto / target_bytes))
    company = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("_n", company).filter("_n > 1").select("folder", "bin", "path", "length")


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Bring a replacement that was cut off to its end; False where none was under way.

    Every step may be repeated: a file that has been moved or deleted is passed by.
    """
    root = qualified(spark, path).rstrip("/")
    note = f"{root}/{COMPACTION_NOTE}"
    if not exists(spark, note):
        return False
    plan = json.loads(read_text(spark, note))
    for made, place in plan["made"]:
        if exists(spark, made):
            move_file(spark, made, place)
    for old in plan["old"]:
        delete_folder(spark, old)
    delete_folder(spark, plan["folder"])
    delete_folder(spark, note)
    return True


def compact_small_files(
    spark: SparkSession, path: str, small_bytes: int = 32 * 1024 * 1024, target_bytes: int = 512 * 1024 * 1024
) -> tuple[int, int]:
    """Replace the small files of a Parquet table by larger ones; (files replaced, files made).

    Only files below ``small_bytes`` are read, and only where a folder has some that fit together (see
    :func:`small_file_groups`); all others keep their names and are not touched, so a run costs what was added since the last
    one. Partition folders stay as they are. The new files are written to a hidden folder and their rows counted; then a note
    with both lists is stored, and the files are exchanged. If that is cut off, the next call, or
    :func:`finish_compaction`, completes it; a run cut off before its note leaves a hidden folder and changes nothing. Between the note and the end a reader may see rows twice: for tables that are read all
    the time use :func:`compact`. Files that others add meanwhile are left alone. The driver holds the names of the
    small files, as a scan of them does. Tables without small files, or without any, are left as they are; a stream
    sink's folder is an error, since its log names its files.
    """
    root = qualified(spark, path).rstrip("/")
    if exists(spark, f"{root}/{COMMIT_LOG}"):
        raise ValueError(f"{path} is a stream sink's folder: its log names its files")
    finish_compaction(spark, path)
    if small_bytes > target_bytes:
        raise ValueError("files of the target size would be small ones again")
    own = _file_session(spark, target_bytes)
    old = sorted(r.path for r in small_file_groups(own, root, small_bytes, target_bytes).select("path").collect())
    if not old:
        return 0, 0
    by = [part.split("=", 1)[0] for part in old[0][len(root) + 1 :].split("/")[:-1]]
    run = uuid.uuid4().hex
    folder = f"{root}/_compacted-{run}"
    rows = own.read.option("basePath", root).option("mergeSchema", True).parquet(*old)
    written = _rewrite(rows.hint("rebalance", *by) if by else rows, folder, by)
    expected = rows.groupBy().count().first()[0]
    stored = own.read.parquet(folder).count()
    if not expected == written == stored:
        delete_folder(spark, folder)
        raise RuntimeError(f"{path}: {expected} rows read, {written} written, {stored} stored")
    made = sorted(r.path for r in parquet_files(own, folder).select("path").collect())
    pairs = [(one, f"{root}/{one[len(folder) + 1 :]}") for one in made]
    write_text(spark, f"{root}/{COMPACTION_NOTE}", json.dumps({"folder": folder, "made": pairs, "old": old}))
    finish_compaction(spark, path)
    return len(old), len(made)


def repartition_table(
    spark: SparkSession, src: str, dst: str, by: list[str], target_bytes: int = 512 * 1024 * 1024
) -> DataFrame:
    """Rewrite a Parquet table with other partition columns and return the new table."""
    own = _file_session(spark, target_bytes)
    # Types come from the reader's own session here: a former partition column becomes a data column.
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    written = _rewrite(_whole(own, src).hint("rebalance", *by), dst, by)
    return _verified(spark, src, dst, written)


def retain(df: DataFrame, ts_col: str, now: datetime | Column, days: int) -> tuple[DataFrame, DataFrame]:
    """(kept, archived): rows of the last ``days`` days and all older ones.

    A row without a time is kept, as its age is unknown. The halves add up to the input.
    """
    moment = now if isinstance(now, Column) else F.lit(now)
    cutoff = moment.cast(df.schema[ts_col].dataType) - F.make_dt_interval(F.lit(days))
    old = F.coalesce(F.col(ts_col) < cutoff, F.lit(False))
    return df.filter(~old), df.filter(old)
