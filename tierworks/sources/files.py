"""CSV and JSON-lines folders as DataFrames, and discovery of such folders below a root."""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierworks.plans.sizing import join_per_group
from tierworks.plans.workspace import settle
from tierworks.sources.listing import arrow_file, arrow_readable, entries, exists, qualified

log = logging.getLogger(__name__)

# Which reader takes a file is decided by its ending (fixed values).
GLOBS = {"csv": "*.{csv,csv.gz}", "json": "*.{json,jsonl,json.gz,jsonl.gz}"}
ENDINGS = {"csv": r"\.csv(\.gz)?$", "json": r"\.jsonl?(\.gz)?$"}
FILES_AT_ONCE = 4
# What folders of landed batches are called, and the file by which Spark marks a folder complete.
BATCH, COMPLETE = "batch-", "_SUCCESS"


@dataclass(frozen=True)
class Source:
    """One raw folder, with the number of its part files per format."""

    name: str
    path: str
    csv_files: int = 0
    json_files: int = 0
    folders: tuple[str, ...] = ()  # those that hold part files: the raw folder itself, and its complete batches

    @property
    def empty(self) -> bool:
        return not (self.csv_files or self.json_files)


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Non-empty files of folders. Spark lists them; no file is opened and no name comes to Python."""
    return spark.read.format("binaryFile").load(paths).filter("length > 0").select("path")


def _with_counts(spark: SparkSession, folders: dict[str, str]) -> list[Source]:
    if not folders:
        return []
    places = {name: [qualified(spark, path), *_complete_batches(spark, path)] for name, path in folders.items()}
    kinds = [F.count_if(F.col("path").rlike(ENDINGS[k])).alias(k) for k in ("csv", "json")]
    parent = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    counts = _listing(spark, [p for own in places.values() for p in own]).groupBy(parent.alias("folder")).agg(*kinds)
    found = {row["folder"]: (row["csv"], row["json"]) for row in counts.collect()}
    return [_counted(name, folders[name], own, found) for name, own in sorted(places.items())]


def _counted(name: str, path: str, places: list[str], found: dict[str, tuple[int, int]]) -> Source:
    own = [p for p in places if p in found]
    return Source(name, path, sum(found[p][0] for p in own), sum(found[p][1] for p in own), tuple(own))


def _complete_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the batches that were landed whole."""
    batches = [e.path for e in entries(spark, path) if e.is_dir and e.name.startswith(BATCH)]
    return [b for b in batches if exists(spark, f"{b}/{COMPLETE}")]


def source_at(spark: SparkSession, path: str) -> Source:
    """The part files of one folder. The format is chosen per file, by its ending."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no such source folder: {path}")
    return _with_counts(spark, {path.rstrip("/").rsplit("/", 1)[-1]: path})[0]


def discover_sources(spark: SparkSession, root: str, only: list[str] | None = None) -> list[Source]:
    """Every folder below ``root``, or the named ones; a missing name is skipped with a warning."""
    if not exists(spark, root):
        raise FileNotFoundError(f"no such folder: {root}")
    folders = {e.name: e.path for e in entries(spark, root) if e.is_dir}
    for name in only or []:
        if name not in folders:
            log.warning("skipping %s: no such folder below %s", name, root)
    return _with_counts(spark, {n: p for n, p in folders.items() if only is None or n in only})


def _first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        headers = []
        for uri in batch["path"]:
            fs, path = arrow_file(uri)
            with fs.open_input_stream(path) as raw:
                text = io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8-sig", newline="")
                headers.append(next(csv.reader(text), []))
        yield pd.DataFrame({"path": batch["path"], "header": headers})


def csv_headers(spark: SparkSession, source: Source) -> DataFrame:
    """``path``, ``header`` (array of names) per CSV file; only the start of each file is read."""
    schema = "path string, header array<string>"
    if arrow_readable(source.path):
        names = _listing(spark, list(source.folders)).filter(F.col("path").rlike(ENDINGS["csv"]))
        tasks = min(source.csv_files, FILES_AT_ONCE * spark.sparkContext.defaultParallelism)
        return names.repartition(tasks).mapInPandas(_first_records, schema)
    # Stores that pyarrow cannot open: let Spark read the first block of each file as lines.
    lines = spark.read.option("pathGlobFilter", GLOBS["csv"]).text(list(source.folders)).select(
        "value",
        scanned_path().alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
    )
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "nth").alias("line"))
    fields = F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), 1)
    bare = F.transform(fields, lambda f: F.replace(F.regexp_replace(f, r'(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))
    return first.select("path", bare.alias("header"))


def scanned_path() -> Column:
    """The path of a row's file, written as a listing writes it."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def column_names(header: list[str]) -> list[str]:
    """Names of a header's columns: an empty one after its position, repeats (in any case) with their position added."""
    folded = [n.lower() for n in header]
    names: list[str] = []
    for i, name in enumerate(header):
        own = f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name
        while own.lower() in {n.lower() for n in names}:
            own += "_"
        names.append(own)
    return names


def read_csv_files(spark: SparkSession, source: Source, multi_line: bool = False) -> DataFrame:
    """Header CSV files with every column STRING, matched by column name across files.

    Spark binds CSV columns by position, which would mix up files whose header order differs. The
    headers are therefore compared first, on the cluster; only the distinct ones reach the driver. Where all
    agree, the folder is read as it is. Otherwise it is read once by position, each row learns its file's header
    from a join on the file's path, and names take their values from there; a column that a file lacks is NULL
    for its rows. Names follow one rule however many files there are, see :func:`column_names`; names of several
    files meet in any case. ``multi_line`` reads line breaks within quotes as part of a value.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", GLOBS["csv"]).option("multiLine", multi_line)
    headers = settle(
        csv_headers(spark, source)
        .filter(F.size("header") > 0)
        .select("path", "header", F.xxhash64("header").alias("kind"))
    )
    known = sorted((list(r["header"]), r["kind"]) for r in headers.select("header", "kind").distinct().collect())
    if not known:
        return reader.csv(list(source.folders))
    if len(known) == 1:
        return reader.schema(_texts(column_names(known[0][0]))).csv(list(source.folders))
    if len({kind for _, kind in known}) < len(known):
        raise ValueError(f"two headers in {source.path} have one fingerprint")
    places = _texts([f"_p{i}" for i in range(max(len(header) for header, _ in known))])
    rows = reader.schema(places).csv(list(source.folders)).withColumn("_file", scanned_path())
    joined = join_per_group(rows, headers.select(F.col("path").alias("_file"), "kind"), ["_file"])
    values: dict[str, tuple[str, Column | None]] = {}
    for header, kind in known:
        for i, name in enumerate(column_names(header)):
            shown, chain = values.get(name.lower(), (name, None))
            when = F.when if chain is None else chain.when
            values[name.lower()] = (shown, when(F.col("kind") == kind, F.col(f"_p{i}")))
    return joined.select(*[chain.alias(name) for name, chain in values.values()])


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_json_files(
    spark: SparkSession,
    source: Source,
    schema: T.StructType | str | None = None,
    as_strings: bool = False,
) -> DataFrame:
    """JSON-lines files; a given ``schema`` saves the pass over the data that inference needs."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    reader = reader.option("pathGlobFilter", GLOBS["json"])
    return reader.option("primitivesAsString", as_strings).json(list(source.folders))


def read_csv_source(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    source = source_at(spark, path)
    if not source.csv_files:
        raise FileNotFoundError(f"no CSV files in {path}")
    return read_csv_files(spark, source, multi_line)


def read_json_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    as_strings: bool = False,
) -> DataFrame:
    source = source_at(spark, path)
    if not source.json_files:
        raise FileNotFoundError(f"no JSON files in {path}")
    return read_json_files(spark, source, schema, as_strings)


def read_source(spark: SparkSession, source: Source, as_strings: bool = False) -> DataFrame:
    """All rows of a folder. Where CSV and JSON meet, JSON values are read as text to match."""
    mixed = bool(source.csv_files and source.json_files)
    parts = []
    if source.csv_files:
        parts.append(read_csv_files(spark, source))
    if source.json_files:
        parts.append(read_json_files(spark, source, as_strings=as_strings or mixed))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
