"""Ranked search against scoring every document for every item."""

import collections
import math
import random
import re

import numpy as np
import pytest
from conftest_llm import lower, prose

from tierworks.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text))


def brute(docs, items, k=10):
    counted = [(d, collections.Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = collections.Counter(t for _, c in counted for t in c)
    own = collections.defaultdict(set)
    for i, t in items:
        own[i] |= set(terms(t))
    rows = []
    for item, words in own.items():
        scored = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in words & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        rows += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(rows, key=str)


def found(spark, docs, items, k=10):
    rows = [(d, t, "mine", 1, 2) for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, terms string, number long, rank long").repartition(5)
    it = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, item long")
    out = lexical.search(df, it, k=k)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in out.collect()), key=str)


def tables(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["w" + str(k) for k in range(300)] + ["Été", "été", "ÉTÉ", "日本"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]

    def text(most):
        return " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, most))).replace("w1 ", "W1, ")

    items = [(k, text(30)) for k in range(12)] + [(3, "w5 w6"), (None, "w1 w299"), (90, None), (91, "!!"), (92, "unknown"), (93, "w0 " * 2000)]
    docs = [(k, text(200)) for k in range(n)] + [(n + k, items[k % 5][1] + " " + text(9)) for k in range(40)]
    docs += [(5000 - k, "w7 w8 w9") for k in range(60)]  # copies: ties
    docs += [(7, "w1 w2"), (7, "w1 w2"), (None, "w7 w8 w9"), (6000, None), (6001, ""), (6002, "?"), (6003, "w3 " * 60_000 + "w4")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_scoring_everything(spark, seed):
    docs, items = tables(seed)
    assert found(spark, docs, items) == brute(docs, items)


def test_small_trees_blocks_and_seed(spark, monkeypatch):
    for name, value in {"TREE_DOCS": 70, "TREE_ENTRIES": 900, "LEAF_DOCS": 3, "BLOCK_TERMS": 40, "BLOCK_ITEMS": 4, "SEED_DOCS": 60, "PARTS": 3}.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = tables(3, n=250)
    assert found(spark, docs, items, k=4) == brute(docs, items, k=4)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], [(1, None)]) == []


def sparse(rng, n, width):
    sizes = rng.integers(1, 12, n)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    picked = [np.sort(rng.choice(width, s, replace=False)) for s in sizes]
    return bounds, np.concatenate(picked).astype(np.int64), rng.integers(1, 1_000_000, bounds[-1])


def test_bounds_are_never_below_a_score(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF_DOCS", 2)
    rng = np.random.default_rng(4)
    bounds, terms_, values = sparse(rng, 300, 40)
    copies = np.concatenate((np.arange(300), np.zeros(50, np.int64)))
    bounds, terms_, values = lexical._taken(copies, bounds, terms_, values)
    tree = lexical.Tree(bounds, terms_, values, copies, np.zeros(350, bool))
    weights = rng.integers(0, 30_000, 40)
    items = lexical.Items(np.arange(3), np.arange(40), np.array([0, 1, 6, 46]), np.concatenate(([0], np.arange(5, 10), np.arange(40))))
    tree.search(items, weights, lexical.Best(3, 350, np.zeros(3, np.int64)))
    dense = np.zeros((350, 40), np.int64)
    for k in range(350):
        dense[k, terms_[bounds[k] : bounds[k + 1]]] = values[bounds[k] : bounds[k + 1]]
    seen = 0

    def below(node):
        nonlocal seen
        rows = tree.order[node.low] if node.left is None else np.concatenate((below(node.left), below(node.right)))
        for k in range(3):
            query = np.zeros(40, np.int64)
            query[items.terms[items.bounds[k] : items.bounds[k + 1]]] = weights[items.terms[items.bounds[k] : items.bounds[k + 1]]]
            if node.bounds is not None:
                seen += 1
                assert node.bounds[k] >= (dense[rows] @ query).max()
        return rows

    assert sorted(below(tree.root).tolist()) == list(range(350)) and seen > 900


def test_subtrees_are_passed_over():
    """Documents in far-apart groups: an item of one group scores few documents of the others."""
    rng = np.random.default_rng(5)
    n = 4000
    group = np.arange(n) % 8
    terms_ = (group[:, None] * 10 + np.arange(10)).ravel().astype(np.int64)
    values = rng.integers(500_000, 510_000, 10 * n)
    tree = lexical.Tree(np.arange(0, 10 * n + 1, 10), terms_, values, np.arange(n), np.zeros(n, bool))
    items = lexical.Items(np.arange(1), np.arange(80), np.array([0, 10]), np.arange(10, 20))
    best = lexical.Best(1, 10, np.zeros(1, np.int64))
    tree.search(items, np.full(80, 1000), best)
    assert tree.docs_scored < n / 4
    scores = values.reshape(n, 10).sum(1) * 1000 * (group == 1)
    assert sorted(e[0] for e in best.heaps[0]) == sorted(scores)[-10:]


def test_large_numbers_do_not_overflow():
    corpus = lexical.Corpus(10**12, 10**15, np.zeros(1, np.int64))
    n = np.array([10**9, 1000])
    m = [10 + 90 * x * 10**12 // 10**15 for x in n.tolist()]
    got = lexical.impacts(n, np.array([5, 7]), np.array([0, 1]), corpus)
    assert got.tolist() == [10**9 * c // (1000 * c + 8 * k) for c, k in zip((5, 7), m)]


def test_sql(spark):
    from oracle import connect, differences

    sf_dir = "/root/testdata/sf0.01"
    assert differences(queries.op11_lexical_search(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op11_lexical_search"]) == ""
