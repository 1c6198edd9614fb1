import hashlib
import random

import corpus_pipeline as P
import pyarrow as pa
import pytest
from conftest_llm import DOCS, prose
from oracle import connect, differences
from pyspark.sql import functions as F
from test_bpe import library  # noqa: F401

from tierworks.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"


def test_url_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(Q.queries()["op8_url_filters"](spark, sf_dir), connect(sf_dir), Q.oracle_sql()["op8_url_filters"]) == ""


def test_one_query_for_each_operator():
    names = list(Q.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert set(Q.oracle_sql()) <= set(names)


def test_stages_keep_the_columns_of_documents(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = P.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", None, None, None), (None, "a " * 30, "en", "s", 3)]])
def test_odd_documents(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() <= len(rows)


def test_stages_follow_the_order_of_the_contract():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "encoding"]


def test_passages_of_over_50_words_go(spark):
    rng = random.Random(51)
    passage, fifty = ("".join(rng.choices("abcdefgh", k=4)) for _ in range(51)), ("".join(rng.choices("abcdefgh", k=4)) for _ in range(50))
    passage, fifty = list(passage), list(fifty)
    own = [f"x{k} {prose(rng, 80)} y{k}" for k in range(12)]
    spread = [" ".join(passage), "\n".join(passage), "  ".join(passage)]
    texts = [f"{own[2 * k]} {spread[k]} {own[2 * k + 1]}" for k in range(3)]
    texts += [f"{own[2 * k]} {' '.join(fifty)} {own[2 * k + 1]}" for k in range(3, 5)]
    texts += ["日本語" * 60 + "一", "二" + "日本語" * 60, own[10], own[10], " ".join(passage[:50])]
    docs = spark.createDataFrame([(k, t, None, None, len(t)) for k, t in enumerate(texts)], DOCS)
    left = {r.doc_id: r.text for r in P.repeated_passages(spark, docs, SF_DIR).collect()}
    want = {k: f"{own[2 * k]}  {own[2 * k + 1]}" for k in range(3)} | {k: texts[k] for k in (3, 4, 9)} | {5: "一", 6: "二"}
    assert left == want


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_a_stage_called_alone_works_in_small_batches(spark, name, stage):
    stock = spark.newSession()
    stage(stock, stock.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([b.nbytes], pa.int64())})

    texts = stock.range(0, 10_000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 10_000 * 2_000 and max(found) < 1.5 * P.BATCH_BYTES


def test_a_run_leaves_the_size_of_batches(spark):
    stock = spark.newSession()
    stock.conf.set(P.BATCH_SETTING, 5 << 20)
    P.run(stock, SF_DIR)
    assert int(stock.conf.get(P.BATCH_SETTING)) == 5 << 20
