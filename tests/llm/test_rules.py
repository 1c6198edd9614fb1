import collections
import re

import numpy as np
import pytest
from conftest_llm import WORD
from pyspark.sql import functions as F

from tierworks.llm import quality_rules as rules


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i : i + 5])] > 1}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))


def test_statistics(docs):
    odd = docs.withColumn("n_words", F.lit("clash"))
    for row in rules.with_statistics(odd).collect():
        assert tuple(row[c] for c in rules.STATISTICS) == brute(row.text)


def test_judge_keeps_all_rows_and_applies_base_rules(spark, docs, corpus):
    labels = spark.createDataFrame([(k, k % 2) for k in range(len(corpus))] + [(None, 1), (1, None)], "doc_id long, quality int")
    rows = rules.judge(docs, labels).collect()
    assert len(rows) == len(corpus)
    for row in rows:
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.base_failed == failed and not (failed and row.kept)


def test_learns_planted_rules():
    rng = np.random.default_rng(0)
    n = 3000
    table = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    bad = (table["a"] > 0.9) | ((table["b"] < 0.2) & (table["c"] > 0.7))
    learned = rules.learn_rules(table, bad)
    hit = np.zeros(n, bool)
    for rule in learned:
        hit[rules.covered(rule, table, np.arange(n))] = True
    assert (hit == bad).mean() > 0.97


def test_verdict_is_the_list_in_order(spark):
    learned = [(rules.Condition("n_words", False, 3.0),), (rules.Condition("n_words", False, 5.0), rules.Condition("symbols_per_word", True, 0.5))]
    rows = [(k, 2 * k, s, 0, 0, 1, 0, 0, k) for k, s in ((2, 0), (4, 4), (4, 0), (9, 9), (0, 0))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in (*rules.STATISTICS, *rules.MORE_STATISTICS)))
    assert [r[0] for r in df.select(rules.verdict(learned)).collect()] == [1, 2, 0, 0, 1]


@pytest.mark.parametrize("labelled", [False, True])
def test_without_documents_or_labels(spark, docs, empty, labelled):
    labels = spark.createDataFrame([(1, 0), (2, 1)] if labelled else [], "doc_id long, quality int")
    assert rules.judge(empty, labels).count() == 0
    assert rules.judge(docs, labels).filter("rejected_by <> 0").count() == 0


def test_fit_is_bounded_whatever_repeats(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(rules, "learn_rules", lambda table, bad: seen.append((table, bad)) or [])
    documents = spark.range(300).selectExpr("id % 3 AS doc_id", "repeat('word ', cast(id AS int)) AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "doc_id long, quality int")
    for bound, rows in ((10, 10), (2, 2), (1000, 300)):
        rules.fit(documents, labels, bound)
        table, bad = seen.pop()
        assert len(bad) == rows and all(len(v) == rows for v in table.values())
