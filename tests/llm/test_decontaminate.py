import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import lower, prose
from pyspark.sql import functions as F

from tierworks.llm import arrays, decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def brute(text, items):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for name, item in items:
        own = WORD.findall(lower(item))
        size = min(13, len(own))
        windows = {tuple(own[a : a + size]) for a in range(len(own) - size + 1)} if own else set()
        for a in range(len(words) - size + 1 if own else 0):
            if tuple(words[a : a + size]) in windows:
                hit |= set(range(a, a + size))
                found.add(name)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("piece", [1 << 18, 20])
def test_matcher_against_brute_force(monkeypatch, piece):
    monkeypatch.setattr(D, "PIECE_WORDS", piece)
    rng = random.Random(6)
    for _ in range(25):
        vocabulary = ["a", "bb", "é", "x1", "日本", "the"][: rng.randint(2, 6)]
        items = [(str(k % 7), " ".join(rng.choices(vocabulary, k=rng.randint(0, 25)))) for k in range(10)]
        texts = []
        for _ in range(20):
            words = rng.choices([*vocabulary, "zz"], k=rng.randint(0, 30)) + rng.choice(items)[1].upper().split()[: rng.randint(0, 25)]
            texts.append(rng.choice([" ", ", ", "-"]).join(words))
        names, counts, hashes = [], [], []
        for name, item in items:
            data = np.frombuffer(item.encode(), np.uint8)
            own = D.word_hashes(data, np.array([0, len(data)]))[1]
            if len(own):
                names.append(name), counts.append(len(own)), hashes.append(own)
        matcher = D.Matcher(names, np.array(counts), np.concatenate(hashes))
        for block in arrays.blocks(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])):
            found, own = D.word_hashes(block.data, block.bounds)
            ranges, named = matcher.search(own, found.first)
            for k, text in enumerate(block.rows.column(0).to_pylist()):
                hit = {w for a, b in ranges.get(k, []) for w in range(a, b + 1)}
                assert (int(np.diff(found.first)[k]), len(hit), sorted(named.get(k, ()))) == brute(text, items)


def planted(rng):
    items = [(k, prose(rng, n)) for k, n in enumerate((30, 14, 13, 5, 1))] + [(9, None), (10, ""), (11, prose(rng, 20)), (11, prose(rng, 20)), (None, prose(rng, 15))]
    items[4] = (4, "singleword")
    texts = [prose(rng, 40) + " " + (t or "") + " " + prose(rng, 40) for _, t in items] + [prose(rng, 300) + " " + items[1][1]]
    return items, [(k, t) for k, t in enumerate([*texts, None, "", "!!"])]


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 25])
def test_table_in_one_or_several_blocks(spark, block_words):
    items, docs = planted(random.Random(7))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit("clash"))
    rows = D.find_items(df, spark.createDataFrame(items, ITEM), block_words=block_words).collect()
    named = [("" if k is None else str(k), t) for k, t in items]
    for row in rows:
        n, hit, found = brute(row.text, named)
        assert (row.n_words, row.n_hit, row.item_ids) == (n, hit, found)
        assert row.contaminated == (hit > 0 and 20 * hit >= n)


def test_cut_texts(spark):
    items, docs = planted(random.Random(7))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id: r.text for r in D.decontaminate(df, spark.createDataFrame(items, ITEM)).collect()}
    assert left[len(items)].rstrip() == docs[len(items)][1].removesuffix(items[1][1]).rstrip()
    assert left[len(items) + 1] is None and left[len(items) + 2] == ""


def test_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], ITEM)
    assert D.find_items(docs, none).filter("contaminated OR n_hit > 0").count() == 0
    assert D.find_items(empty, spark.createDataFrame([(1, "a b")], ITEM)).count() == 0
