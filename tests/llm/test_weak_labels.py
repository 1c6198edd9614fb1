import random

import numpy as np
from conftest_llm import prose
from pyspark.sql import functions as F

from tierworks.llm import weak_labels as W


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    bad = rng.random(20_000) < 0.3
    right = (0.9, 0.8, 0.7, 0.95)
    counts = {}
    votes = np.stack([np.where(rng.random(len(bad)) < a, bad, ~bad) for a in right], axis=1) * 2 - 1
    votes[rng.random(votes.shape) < 0.2] = 0
    for pattern in map(tuple, votes.tolist()):
        counts[pattern] = counts.get(pattern, 0) + 1
    found, posteriors = W.label_model(list("abcd"), counts)
    assert all(abs(found[n] - a) < 0.05 for n, a in zip("abcd", right))
    judged = np.array([posteriors[tuple(v)] > 0.5 for v in votes.tolist()])
    assert (judged == bad).mean() > 0.93
    assert W.label_model(["a"], {}) == ({}, {})


def made(rng, n):
    rows, labels = [], []
    for k in range(n):
        text, quality, toxic = prose(rng, rng.randint(30, 120)), 1, 0
        if k % 10 == 0:
            text, quality = " ".join(f"{w.upper()}!!" for w in text.split()), 0
        elif k % 10 == 1:
            words = text.split()
            for w in rng.choices(["zzqx", "zzqxar", "zzqxel"], k=4):
                words.insert(rng.randint(0, len(words)), w)
            text, toxic = " ".join(words), 1
        elif k % 10 == 2:
            text += " zzqx"  # once is not enough
        rows.append((k, text))
        if k % 2 == 0 or k % 3 == 0:
            labels.append((k, quality, toxic))
    return rows, labels


def test_catches_planted_rows(spark):
    rows, labels = made(random.Random(2), 600)
    docs = spark.createDataFrame([*rows, (None, None), (9999, "")], "doc_id long, text string").withColumn("kept", F.lit("clash"))
    heads = W.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = W.classify(docs, heads).collect()
    assert len(found) == len(rows) + 2
    by_kind = {}
    for r in found:
        if r.text:
            by_kind.setdefault(r.doc_id % 10, []).append(r.kept)
        else:
            assert not r.kept
    assert np.mean(by_kind[0]) < 0.05 and np.mean(by_kind[1]) < 0.1
    assert all(np.mean(by_kind[k]) > 0.95 for k in range(2, 10))


def test_without_labels_or_documents(spark, docs, empty):
    heads = W.fit(docs, None)
    assert W.classify(docs, heads).count() == docs.count()
    assert W.classify(empty, W.fit(empty, None)).count() == 0
