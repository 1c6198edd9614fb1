"""A Parquet table in buckets of its key, of which a change rewrites only those that it touches.

    root/data/version=<n>/_bucket=<b>/   rows of the buckets that version n rewrote
    root/log/version=<n>.json            which version holds each bucket's rows, written last

A version counts once its log is there; what an interrupted write left behind is named nowhere. Readers see the
last version, as a list of folders: no file is ever overwritten. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierworks.plans.workspace import settle
from tierworks.sources.listing import children, exists, matching, read_text, write_text

BUCKET = "_bucket"


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int = 64) -> None:
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)
        log = self.log()
        self.buckets = log["buckets"] if log else buckets

    def _logs(self) -> list[str]:
        return matching(self.spark, f"{self.root}/log/version=*.json")

    def log(self) -> dict | None:
        """The last version: which version holds each bucket (those without rows are not named), and the rows' schema."""
        known = self._logs()
        return json.loads(read_text(self.spark, known[-1])) if known else None

    def has(self, batch_id: str) -> bool:
        """Whether a batch is in the table."""
        name = self._note(batch_id)
        if not exists(self.spark, name):
            return False
        # The note is written before the version that holds the batch, which may never have come about.
        log = self._log(int(read_text(self.spark, name)))
        return exists(self.spark, log) and json.loads(read_text(self.spark, log))["batch_id"] == batch_id

    def _note(self, batch_id: str) -> str:
        return f"{self.root}/log/batch-{hashlib.sha256(batch_id.encode()).hexdigest()}"

    def _log(self, version: int) -> str:
        return f"{self.root}/log/version={version:012d}.json"

    def last(self) -> int:
        known = self._logs()
        return int(known[-1].rsplit("=", 1)[1].split(".")[0]) if known else 0

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into; at most as many as there are."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets; None before the first version."""
        log = self.log()
        if not log:
            return None
        schema = T.StructType.fromJson(log["schema"])
        chosen = set(range(self.buckets)) if buckets is None else set(buckets)
        held = [(version, int(b)) for b, version in log["held_by"].items() if int(b) in chosen]
        if not held:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._data(version)}/{BUCKET}={bucket}" for version, bucket in sorted(held)]
        whole = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*paths).drop("version", BUCKET)

    def rewrite(
        self, fresh: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], batch_id: str | None = None
    ) -> list[int]:
        """``merge(rows of the buckets that fresh falls into, fresh)`` takes these buckets' place; returns the buckets."""
        fresh = settle(fresh)
        touched = self.touched(fresh)
        self.replace(touched, merge(self.read(touched), fresh), batch_id)
        return touched

    def replace(self, buckets: list[int], rows: DataFrame, batch_id: str | None = None) -> int:
        """The next version: ``rows`` instead of what some buckets held, everything else as it was."""
        log = self.log()
        held = {int(b): v for b, v in log["held_by"].items()} if log else {}
        number = self.last() + 1
        filled = set()
        if buckets:
            shaped = rows.withColumn(BUCKET, self.bucket()).filter(F.col(BUCKET).isin(*buckets)).hint("rebalance", BUCKET)
            # A version that was begun and not finished is written over.
            shaped.write.mode("overwrite").partitionBy(BUCKET).parquet(self._data(number))
            filled = {int(e.path.rsplit("=", 1)[1]) for e in self._folders(number)}
        held = {b: v for b, v in held.items() if b not in set(buckets)} | {b: number for b in filled}
        if batch_id is not None:
            write_text(self.spark, self._note(batch_id), str(number))
        made = {"buckets": self.buckets, "held_by": held, "batch_id": batch_id, "schema": rows.schema.jsonValue()}
        write_text(self.spark, self._log(number), json.dumps(made))
        return number

    def _data(self, version: int) -> str:
        return f"{self.root}/data/version={version:012d}"

    def _folders(self, version: int):
        return [e for e in children(self.spark, self._data(version)) if e.is_dir and e.name.startswith(f"{BUCKET}=")]
