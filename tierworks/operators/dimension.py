"""A slowly changing dimension as it is stored: closed versions are only ever added, current rows lie in buckets.

    root/closed/version=<n>/   versions that batch n closed
    root/rejected/version=<n>/ rows of batch n without a whole key
    root/data, root/log        current rows (see :mod:`tierworks.operators.buckets`)

A batch reads the buckets that its keys fall into, writes what it closed, and rewrites the buckets in which something
changed. History is neither read nor written, so what a batch costs does not grow with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierworks.operators.buckets import BucketedTable
from tierworks.operators.landing import version_number, versions
from tierworks.operators.scd2 import _moment, scd2_apply
from tierworks.plans.workspace import settle
from tierworks.sources.listing import delete_folder


class StoredDimension:
    """Apply batches with :meth:`apply`; read with :meth:`current` (the current rows only) or :meth:`read` (all versions)."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], tracked: list[str], buckets: int = 64) -> None:
        self.spark, self.root, self.key, self.tracked = spark, root.rstrip("/"), list(key), list(tracked)
        self.table = BucketedTable(spark, self.root, key, buckets)

    def apply(self, incoming: DataFrame, as_of, batch_id: str | None = None) -> bool:
        """One batch, with the rules of :func:`scd2_apply`; False if a batch of this id is in already.

        Rows without a whole key are kept below ``rejected``. A key that occurs twice in the batch, and an ``as_of`` that is not
        after the start of a version it would close, fail the job and leave the table as it was.
        """
        if batch_id is not None and self.table.has(batch_id):
            return False
        number = self.table.last() + 1
        for name in ("closed", "rejected"):  # of a batch that was begun and not finished
            delete_folder(self.spark, f"{self.root}/{name}/version={number:012d}")
        seen = Observation()
        whole = F.lit(True)
        for name in self.key:
            whole = whole & F.col(name).isNotNull()
        held = settle(incoming.observe(seen, F.count_if(~whole).alias("broken")))
        if seen.get["broken"]:
            self._add("rejected", number, held.filter(~whole))
        usable = held.filter(whole)
        standing = self.table.read(self.table.touched(usable))
        at = _moment(as_of)
        if standing is not None:
            at = at.cast(standing.schema["effective_from"].dataType)
        after = settle(scd2_apply(standing, usable, self.key, self.tracked, at))
        opened = F.col("is_current") & (F.col("effective_from") == at)
        counts = after.groupBy(self.table.bucket().alias("bucket")).agg(F.count_if(~F.col("is_current")).alias("closed"), F.count_if(opened).alias("opened"))
        changed = counts.filter("closed + opened > 0").collect()  # a row for each bucket at the most
        if any(r["closed"] for r in changed):
            self._add("closed", number, after.filter(~F.col("is_current")))
        self.table.replace([r["bucket"] for r in changed], after.filter("is_current"), batch_id)
        return True

    def _add(self, name: str, number: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/version={number:012d}")

    def current(self) -> DataFrame | None:
        return self.table.read()

    def closed(self) -> DataFrame | None:
        return self._added("closed")

    def rejected(self) -> DataFrame | None:
        return self._added("rejected")

    def _added(self, name: str) -> DataFrame | None:
        """What committed batches added below ``name``."""
        last = self.table.last()
        paths = [p for p in versions(self.spark, f"{self.root}/{name}") if version_number(p) <= last]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.root}/{name}").option("mergeSchema", True).parquet(*paths).drop("version")

    def read(self) -> DataFrame | None:
        """All versions, closed and current; None before the first batch."""
        current, closed = self.current(), self.closed()
        return current if closed is None else current.unionByName(closed, allowMissingColumns=True)
