"""Writing tables: full refresh, append-only batches, and landing of all raw sources."""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierworks.operators.contract import with_contract
from tierworks.sources.catalog import database_folder, ensure_namespace, is_path
from tierworks.sources.files import BATCH, COMPLETE, Source, discover_sources, read_source
from tierworks.sources.listing import delete_folder, exists, modified, parquet_files
from tierworks.sources.runs import RUN_SCHEMA
from tierworks.sources.versions import read_latest, unfinished_versions, version_number, versions

PARALLEL_SOURCES = 4


def full_refresh(
    df: DataFrame,
    target: str,
    partition_by: tuple[str, ...] | list[str] = (),
    max_records_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    """Replace a table (catalog name or path) by ``df``. ``df`` must not read from the target.

    With ``partition_by`` the rows are first rebalanced on those columns, so each value is written by
    few tasks and adaptive execution still splits a value that is too large for one. That is a shuffle:
    ``rebalance=False`` saves it for rows that come from a table laid out the same way.
    """
    shaped = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    writer = shaped.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def version_times(spark: SparkSession, root: str) -> list[tuple[int, str, datetime]]:
    """(number, path, when it was completed) of the complete versions, oldest first."""
    return [(version_number(p), p, modified(spark, f"{p}/_SUCCESS")) for p in versions(spark, root)]


def read_version(
    spark: SparkSession, root: str, number: int | None = None, as_of: datetime | None = None
) -> DataFrame | None:
    """A table as its version ``number`` was, or as it was at ``as_of``; None where no such version is.

    ``as_of`` (with a zone, else read as UTC) takes the last version that was complete by then.
    """
    if (number is None) == (as_of is None):
        raise ValueError("give either a number or a time")
    if as_of is not None and as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    found = [p for n, p, at in version_times(spark, root) if (n == number if as_of is None else at <= as_of)]
    return spark.read.parquet(found[-1]) if found else None


def expire_versions(
    spark: SparkSession, root: str, keep: int = 1, older_than_days: float = 0, now: datetime | None = None, apply: bool = False
) -> list[str]:
    """Paths of the versions that are neither among the newest ``keep`` nor younger than ``older_than_days``.

    A report, unless ``apply`` is set: then these versions are deleted. The newest version always stays.
    """
    before = (now or datetime.now(timezone.utc)) - timedelta(days=older_than_days)
    old = version_times(spark, root)[: -max(1, keep)]
    paths = [path for _, path, at in old if at <= before]
    for path in paths if apply else ():
        delete_folder(spark, path)
    return paths


def publish(
    df: DataFrame,
    root: str,
    partition_by: tuple[str, ...] | list[str] = (),
    rebalance: bool = True,
) -> str:
    """Write ``df`` as the next version of the table below ``root`` and return its path.

    The way to store a table computed from its own previous version: nothing that the plan reads is
    overwritten, and a version counts only once it is complete. One writer at a time.
    """
    known = versions(df.sparkSession, root)
    last = version_number(known[-1]) if known else 0
    path = f"{root.rstrip('/')}/version={last + 1:012d}"
    full_refresh(df, path, partition_by, rebalance=rebalance)
    return path


def replace_table(
    df: DataFrame,
    target: str,
    partition_by: tuple[str, ...] | list[str] = (),
    rebalance: bool = True,
    keep: int | None = None,
) -> str:
    """Replace a table (catalog name or path) by ``df`` in one step, and return the folder of the new version.

    The rows are written beside the old ones. For a path they count once they are complete (see
    :func:`tierworks.sources.catalog.read_table`); a name is a view that is then pointed at them. A write that fails leaves
    readers with the old rows, and ``df`` may read from the target. Old versions stay, unless ``keep`` says how many: readers that
    are still at an older one would lose it.
    """
    spark = df.sparkSession
    if is_path(target):
        root = target
    else:
        space, _, name = target.rpartition(".")
        root = f"{database_folder(spark, space or None)}/{name}"
        known = spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType
        if known and known != "VIEW":
            raise ValueError(f"{target} is stored as a table; drop it, so that a view over versions can take its name")
    path = publish(df, root, partition_by, rebalance)
    if not is_path(target):
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM parquet.`{path}`")
    if keep is not None:
        expire_versions(spark, root, keep, apply=True)
    return path


def batch_folder(path: str, batch_id: str) -> str:
    """Where a batch of a raw folder lies; ids are spelled so that they can be a folder's name."""
    plain = "".join(c if c.isalnum() and c.isascii() or c in "-_." else f"%{ord(c):X}" for c in batch_id)
    return f"{path.rstrip('/')}/{BATCH}{plain}"


def land_batch(
    df: DataFrame,
    source: str,
    path: str,
    batch_id: str | None = None,
    ingested_at: str | None = None,
    fmt: str = "csv",
) -> str:
    """Append one stamped batch to a raw folder; returns the batch id. A batch id that has landed already is left as it is.

    The batch has a folder of its own, which counts once Spark has marked it complete, so a batch that is landed twice, or
    again after it was cut off half way, gives its rows once. Rows that already carry the contract columns keep them.
    """
    batch_id = batch_id or str(uuid.uuid4())
    folder = batch_folder(path, batch_id)
    if exists(df.sparkSession, f"{folder}/{COMPLETE}"):
        return batch_id
    if "_batch_id" not in df.columns:
        arrived = ingested_at or datetime.now(timezone.utc).isoformat()
        df = with_contract(df, source, batch_id, arrived)
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(folder) if fmt == "csv" else writer.json(folder)
    return batch_id


def _target(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}" if is_path(base) else f"{base}.{name}"


def _land(spark: SparkSession, source: Source, target: str, as_strings: bool) -> dict:
    """Rebuild one bronze table; the rows are counted while they are written."""
    started = time.monotonic()
    if source.empty:
        return {"source": source.name, "rows": 0, "read_ms": 0.0, "write_ms": 0.0}
    seen = Observation()
    df = read_source(spark, source, as_strings)
    planned = time.monotonic()
    path = replace_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), target)
    done = time.monotonic()
    return {
        "path": path,
        "source": source.name,
        "rows": int(seen.get["rows"]),
        "read_ms": (planned - started) * 1000,
        "write_ms": (done - planned) * 1000,
    }


def land_bronze(
    spark: SparkSession,
    root: str,
    target: str,
    only: list[str] | None = None,
    as_strings: bool = False,
) -> DataFrame:
    """Rebuild one table per raw folder below ``root``; returns ``source``, ``rows``.

    ``target`` is a path or a namespace. Running it again gives the same tables; each one is replaced in one step (see
    :func:`replace_table`), so one that fails stays as it was. The sources are
    independent, so a few are landed at a time. An empty folder is reported with no rows.
    """
    if not is_path(target):
        ensure_namespace(spark, target)
    sources = discover_sources(spark, root, only)
    with ThreadPoolExecutor(PARALLEL_SOURCES) as pool:
        results = list(
            pool.map(lambda s: _land(spark, s, _target(target, s.name), as_strings), sources)
        )
    rows = [(r["source"], r["rows"]) for r in results]
    return spark.createDataFrame(rows, "source string, rows bigint").orderBy("source")


def timed_landing(
    spark: SparkSession,
    root: str,
    target: str,
    only: list[str] | None = None,
    process_start: float | None = None,
) -> DataFrame:
    """Land the sources one after the other and return the run record (one row).

    Reading is fused with writing, so ``read_ms`` is listing plus schema discovery. ``process_start``
    is a ``time.monotonic()`` value for the clock that includes start-up.
    """
    began, stamp = time.monotonic(), datetime.now(timezone.utc).isoformat()
    if not is_path(target):
        ensure_namespace(spark, target)
    per_source = []
    for source in discover_sources(spark, root, only):
        place = _target(target, source.name)
        result = _land(spark, source, place, False)
        size = 0
        if is_path(place) and not source.empty:
            size = parquet_files(spark, result["path"]).agg(F.sum("length")).first()[0] or 0
        per_source.append(
            (result["source"], result["read_ms"], result["write_ms"], 0.0, result["rows"], size)
        )
    ended = time.monotonic()
    totals = (
        (ended - began) * 1000,
        (ended - (process_start or began)) * 1000,
        sum(p[4] for p in per_source),
        sum(p[5] for p in per_source),
    )
    record = (
        "spark",
        str(uuid.uuid4()),
        stamp,
        [p[0] for p in per_source],
        totals,
        per_source,
        "read fused with write",
        None,
    )
    return spark.createDataFrame([record], RUN_SCHEMA)
