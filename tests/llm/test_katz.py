import collections
import math
import random

import pytest
from conftest_llm import WORD, lower, prose
from pyspark.sql import functions as F

from tierworks.llm import katz


def model(texts, held):
    tokens = {k: [*WORD.findall(lower(t)), 0] for k, t in texts.items()}
    train = [tokens[k] for k in texts if not held[k]]
    words = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([0, *t[:-1]], t))
    total = sum(words.values())

    def shrunk(n, by):
        return n * by[n] if n <= katz.DISCOUNTED else n

    d1, d2 = (katz.discounts(collections.Counter(c.values())) for c in (words, pairs))
    one = {w: shrunk(n, d1) / total for w, n in words.items()}
    left = 1 - sum(one.values())
    if total and left <= 1e-12:
        one, left = {w: p * total / (total + 1) for w, p in one.items()}, 1 / (total + 1)
    own, lower_mass = collections.Counter(), collections.Counter()
    for (v, w), n in pairs.items():
        own[v] += shrunk(n, d2)
        lower_mass[v] += one[w]

    def chance(v, w):
        below = one.get(w, left)
        if v not in words:
            return below
        full = own[v] >= words[v] * (1 - 1e-12)
        if (v, w) in pairs:
            return shrunk(pairs[v, w], d2) / (words[v] + full)
        return (1 - own[v] / (words[v] + full)) / (1 - lower_mass[v]) * below

    return tokens, words, total, chance


def check(spark, texts, held):
    rows = [(k, texts[k], held[k]) for k in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").withColumn("score", F.lit("clash"))
    got = katz.score_texts(df, "doc_id", "text", "held").collect()
    tokens, words, total, chance = model(texts, held)
    assert len(got) == len(texts)
    for r in got:
        own = tokens[r.key]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.key], len(own), sum(w in words for w in own), total)
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(chance(v, w)) for v, w in zip([0, *own[:-1]], own)), rel=1e-9)
    for v in [0, *list(words)[:10]]:
        assert sum(chance(v, w) for w in words) + chance(v, None) == pytest.approx(1)


@pytest.mark.parametrize(("keys", "tokens"), [(1 << 21, 1 << 21), (300, 200)])
def test_against_brute_force(spark, corpus, monkeypatch, keys, tokens):
    monkeypatch.setattr(katz, "PART_KEYS", keys)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", tokens)
    check(spark, {r[0]: r[1] for r in corpus}, {r[0]: r[0] % 5 == 0 for r in corpus})


def test_hot_contexts_are_split(spark, monkeypatch):
    monkeypatch.setattr(katz, "PART_KEYS", 64)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 100)
    rng = random.Random(1)
    texts = {k: " ".join(f"hot {w}" for w in prose(rng, 40).split()) for k in range(30)}
    check(spark, texts, {k: k % 4 == 0 for k in texts})


def test_nothing_to_learn(spark, empty):
    texts = {1: "a b", 2: None, 3: ""}
    check(spark, texts, {k: True for k in texts})
    assert katz.score_texts(empty.withColumn("held", F.lit(False)), "doc_id", "text", "held").count() == 0


def test_sure_contexts_keep_something_over(spark):
    check(spark, {k: "a b c" for k in range(20)} | {20: "a c b x", 21: "x y"}, {k: k >= 20 for k in range(22)})
