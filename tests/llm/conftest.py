import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import DOCS, prose  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    """Small documents with copies, near copies, shared passages, junk, nulls, empty and long texts."""
    rng = random.Random(11)
    base = prose(rng, 160)
    passage = prose(rng, 110)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    texts += [base, base, base.upper(), base + " x", " ".join(["zzz", *base.split()[1:]])]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(4)]
    texts += [None, "", "   \n\t ", "a", "a b c", "a b c", "x " * 400, "!!! ???", "12 34", "日本語 テキスト " * 20]
    texts += [prose(rng, 6000), "é" * 2000, "line one\nline one\nline two\n\n" * 30]
    return [(k, t, ("en", "fr", None)[k % 3], "s", len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
