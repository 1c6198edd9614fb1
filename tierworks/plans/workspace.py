"""The shared folder for intermediate tables, and lineage cuts that outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine; on a cluster a
    missing setting is an error, since executors could not read each other's files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tierworks-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/tierworks/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage; later stages read it back instead of recomputing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
