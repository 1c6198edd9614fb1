"""Token ids as flat binary files: unsigned integers, 64-bit document offsets, memory-mapped reading.

A corpus is a folder of shards, each written by one task from one range of the key:

* ``<shard>.bin``  all ids behind each other, little-endian, 2 bytes each when the vocabulary fits, else 4
* ``<shard>.idx``  unsigned 64-bit offsets in ids: each document's start within the shard, and the end
* ``<shard>.key``  signed 64-bit keys of the documents; NULL keys come first and are counted in the manifest

and a manifest (Parquet) with the shards that count, in order of the key. A task writes under a name of its own
attempt and reports it; what a lost or repeated attempt wrote is named nowhere. Where a shard begins in the
whole corpus is a prefix sum over the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierworks.llm import arrays, bpe
from tierworks.plans.workspace import scratch_path

#: Bytes of text that a shard takes about.
SHARD_BYTES = 32 << 20
MANIFEST = "shard long, name string, width int, n_docs long, n_null_keys long, n_tokens long"
#: Ids that are written or read at once.
PIECE_IDS = 1 << 20


def store(folder: str):
    """The file system of a folder, by its address, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """Encode ``text``, append ``end_id`` and write shards in ascending order of ``key``; returns the manifest.

    NULL texts are empty (only the end id); NULL keys come first. Rows of one key are ordered by their text, so
    repeated rows are kept and stand side by side. Other columns are not read. The table is dealt out by ranges
    of (key, text), so rows of one key can go to several shards.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    n = shards or _shards(rows)
    spread = rows.repartitionByRange(n, F.col("key").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("key").asc_nulls_first(), F.xxhash64("text"), "text"
    )
    numbered = spread.select(F.spark_partition_id().cast("long").alias("shard"), "key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(folder, bpe.encoder(tokenizer), end_id)
        for block in arrays.blocks(batches):
            shard.add(block)
        if shard.n_docs:
            yield shard.close()

    path = f"{folder}/manifest"
    numbered.mapInArrow(write, MANIFEST).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _shards(rows: DataFrame) -> int:
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, int(np.ceil(total / SHARD_BYTES)), min(rows.sparkSession.sparkContext.defaultParallelism, total >> 20))


class _Shard:
    """What one task writes; offsets of the documents stay in memory at 8 bytes each, ids do not."""

    def __init__(self, folder: str, encoder: bpe.Encoder, end_id: int) -> None:
        self.files, self.folder = store(folder)
        self.encoder, self.end_id = encoder, end_id
        self.kind = np.dtype("<u2") if max(encoder.n_ids - 1, end_id) < 1 << 16 else np.dtype("<u4")
        self.name = uuid.uuid4().hex
        self.number = 0
        self.files.create_dir(self.folder, recursive=True)
        self.bin, self.idx, self.key = (self.files.open_output_stream(f"{self.folder}/{self.name}.{x}") for x in ("bin", "idx", "key"))
        self.idx.write(np.zeros(1, "<u8").tobytes())
        self.n_docs = self.n_nulls = self.n_tokens = 0

    def add(self, block: arrays.Block) -> None:
        self.number = block.rows.column(0)[0].as_py()
        ids, bounds = self.encoder.encode(block)
        n = len(bounds) - 1
        whole = np.empty(len(ids) + n, self.kind)
        ends = bounds[1:] + np.arange(n)  # where the end ids go
        is_end = np.zeros(len(whole), bool)
        is_end[ends] = True
        whole[is_end], whole[~is_end] = self.end_id, ids
        self.bin.write(whole.tobytes())
        self.idx.write((self.n_tokens + ends + 1).astype("<u8").tobytes())
        keys = block.rows.column(1)
        self.n_nulls += keys.null_count
        self.key.write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.n_docs += n
        self.n_tokens += len(whole)

    def close(self) -> pa.RecordBatch:
        for file in (self.bin, self.idx, self.key):
            file.close()
        row = {"shard": self.number, "name": self.name, "width": self.kind.itemsize, "n_docs": self.n_docs, "n_null_keys": self.n_nulls, "n_tokens": self.n_tokens}
        schema = pa.schema([("shard", pa.int64()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_null_keys", pa.int64()), ("n_tokens", pa.int64())])
        return pa.RecordBatch.from_pylist([row], schema)


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: ids of all shards before. One row for each shard, so one task orders them."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def mapped(folder: str, name: str, kind: np.dtype, count: int) -> np.ndarray:
    """A file as an array: mapped into memory where the store is a local file system, read elsewhere."""
    from pyarrow import fs

    files, path = store(folder)
    if not count:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r", shape=(count,))
    with files.open_input_file(f"{path}/{name}") as file:
        return np.frombuffer(file.read(), kind)


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``doc_id, start, ids`` of all documents; ``start``: ids of all documents before, ``ids``: 32-bit integers."""
    manifest = with_bases(spark.read.parquet(f"{folder}/manifest"))
    spread = manifest.repartition(max(1, min(manifest.count(), 10_000)), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(folder, row, key)

    return spread.mapInArrow(read, f"`{key}` long, start long, ids binary")


def _documents(folder: str, row: dict, key: str) -> Iterator[pa.RecordBatch]:
    ids = mapped(folder, f"{row['name']}.bin", np.dtype(f"<u{row['width']}"), row["n_tokens"])
    offsets = mapped(folder, f"{row['name']}.idx", np.dtype("<u8"), row["n_docs"] + 1).astype(np.int64)
    keys = mapped(folder, f"{row['name']}.key", np.dtype("<i8"), row["n_docs"])
    at = 0
    while at < row["n_docs"]:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_IDS, "right")) - 1)
        cells = [ids[offsets[k] : offsets[k + 1]].astype("<u4").tobytes() for k in range(at, to)]
        is_null = np.arange(at, to) < row["n_null_keys"]
        columns = [pa.array(np.asarray(keys[at:to]), pa.int64(), mask=is_null), pa.array(row["base"] + offsets[at:to]), pa.array(cells, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [key, "start", "ids"])
        at = to


def round_trip(df: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``df`` into a new folder of the shared place and read it back."""
    folder = scratch_path(df.sparkSession, "tokens")
    write_token_files(df, folder, tokenizer, end_id)
    return read_token_files(df.sparkSession, folder)

