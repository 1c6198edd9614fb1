"""A training corpus from raw documents: five stages, each reading what the one before has kept.

Rules drop documents of low quality, one document of each group of near duplicates stays, repeated passages are
cut out, documents that hold test items go (smaller finds are cut out), and what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.llm import bpe, decontaminate as items, minhash, quality_rules as rules, suffix_dedup
from tierworks.llm.carry import packed, unpacked
from tierworks.llm.queries import tokenizer_path
from tierworks.plans.workspace import scratch_path

#: Words of the shortest passage that counts as repeated; text without white space is judged by bytes alone.
PASSAGE_WORDS = 51
#: Bytes of one Arrow batch. A task holds a few of them on either side; a row that is longer is a batch of its own.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(stage: Stage) -> Stage:
    """``stage``, with batches of ``BATCH_BYTES`` from its call on: Spark reads the setting when rows are computed, so it stays."""

    @wraps(stage)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return staged


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the rules learned from ``labels``."""
    judged = rules.judge(packed(docs, "text", "doc_id"), _table(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*unpacked(docs.columns, "text"))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five words and a similarity of 0.8."""
    return minhash.keep_one(docs)


@in_small_batches
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes and more, that stand twice, cut out; documents of which no word is left go."""
    return with_sizes(suffix_dedup.deduplicated(docs, words=PASSAGE_WORDS))


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that test items cover by a twentieth, and without smaller finds."""
    return with_sizes(items.decontaminate(docs, _table(spark, sf_dir, "benchmark")))


@in_small_batches
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` (32-bit), their number, and digests of them and of the text that they decode to."""
    coded = bpe.with_ids(docs.select("doc_id", "text"), tokenizer_path(), decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


def with_sizes(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the texts are now, where there is such a column; documents without a word are left out."""
    left = docs.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The learned rules, the links and the tokenizer are beyond SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written into the shared folder and read again.

    Afterwards the session has its own size of batches again.
    """
    docs, before = _table(spark, sf_dir, "documents"), spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
