"""Columns that are called like an operator's own come back with their names, types and values."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tierworks.llm import bpe, decontaminate, langid, lexical, minhash, pii, quality_rules, queries, suffix_dedup, token_files, url_filter

NAMES = (
    "ranges __ranges __runs t1 t2 __url n_words hits kept id n removed n_bytes carried comp bucket first last core span a b registers "
    "hidden rejected_by base_failed n_symbols word_chars lang_pred score owner shingle held order part number doc terms counts decoded ids start"
).split()


@pytest.fixture
def odd(spark, docs):
    """Documents with a text column for each name, its value being made of the name and the row."""
    return docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for n in NAMES})


def values(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def whole(df, odd, text="text"):
    """Same columns and types in the same order, and each row's own values."""
    assert df.dtypes == odd.dtypes
    mine = [c for c in odd.columns if c not in (text, "n_chars")]
    before = {r["doc_id"]: tuple(r[c] for c in mine) for r in odd.collect()}
    rows = df.collect()
    assert rows and all(before[r["doc_id"]] == tuple(r[c] for c in mine) for r in rows)


def benchmark(spark, corpus):
    return spark.createDataFrame([(1, corpus[0][1]), (2, " ".join(corpus[5][1].split()[:20]))], "item_id long, text string")


def test_filters_give_back_the_rows(spark, odd, corpus):
    whole(suffix_dedup.deduplicated(odd), odd)
    whole(suffix_dedup.deduplicated(odd, words=51), odd)
    whole(decontaminate.decontaminate(odd, benchmark(spark, corpus)), odd)
    whole(minhash.keep_one(odd), odd)


def test_added_columns_replace_only_their_own(spark, odd):
    cut = suffix_dedup.without_repeats(odd)
    left = [c for c in odd.columns if c not in ("n_bytes", "removed", "kept")]
    assert cut.columns == [*left, "n_bytes", "removed", "kept"]
    assert values(cut, left) == values(odd, left)
    found = langid.predict(odd, langid.fit(odd))
    left = [c for c in odd.columns if c not in ("lang_pred", "score")]
    assert values(found, left) == values(odd, left)
    assert values(pii.find_pii(odd), odd.columns) == values(odd, odd.columns)


def test_urls(spark, odd):
    pages = odd.withColumn("url", F.concat(F.lit("http://a.org/"), F.coalesce("lang", F.lit(""))))
    rules = [(k, *rule) for k, rule in enumerate(url_filter.PATTERN_RULES)]
    judged = url_filter.filter_urls(
        pages,
        queries.inline_rows(spark, queries.DOMAIN_RULES, ("host", "path", "verdict")),
        queries.inline_rows(spark, rules, ("rule_id", "verdict", "pattern")),
    )
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert values(judged, pages.columns) == values(pages, pages.columns)


def test_readers_do_not_see_other_columns(spark, odd, corpus, tmp_path):
    n = odd.count()
    path = queries.tokenizer_path()
    assert bpe.with_ids(odd.select("doc_id", "text"), path, decoded=True).count() == n
    assert token_files.round_trip(odd, path, queries.END_ID).count() == n
    assert minhash.near_duplicates(odd).count() == n
    assert lexical.search(odd, benchmark(spark, corpus)).filter("rank = 1").count() == 2


def test_pipeline_stages_give_back_the_documents_columns(spark, odd, corpus, tmp_path):
    sf_dir = str(tmp_path)
    odd.write.parquet(f"{sf_dir}/documents.parquet")
    benchmark(spark, corpus).write.parquet(f"{sf_dir}/benchmark.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes, name
        whole(out, docs)
        docs = minhash.settle(out)
