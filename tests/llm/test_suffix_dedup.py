import collections
import random
import re

import numpy as np
import pytest
from conftest_llm import DOCS, prose, sha
from pyspark.sql import functions as F

from tierworks.llm import queries, suffix_dedup as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        out.append((len(d), int(gone.sum()), runs, sha(bytes(np.frombuffer(d, np.uint8)[~gone]))))
    return out


def found(df, length):
    rows = S.without_repeats(df, length=length).collect()
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), sha(bytes(r.kept))) for r in rows}


def mosaic(rng, alphabet, length):
    base = "".join(rng.choices(alphabet, k=4 * length))
    text = ""
    for _ in range(rng.randint(0, 4)):
        at = rng.randint(0, 3 * length)
        text += base[at : at + rng.randint(0, 3 * length)] + "".join(rng.choices(alphabet, k=rng.randint(0, length)))
    return text


@pytest.mark.parametrize(("length", "alphabet"), [(20, "abé"), (64, "abcdefgh"), (100, "ab")])
def test_mosaics(spark, monkeypatch, length, alphabet):
    seeds = random.Random(length)
    texts = [mosaic(random.Random(seeds.randint(0, 5)), alphabet, length) for _ in range(40)] + [None, "", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(df, length) == dict(enumerate(brute(texts, length)))


@pytest.mark.parametrize("few", [S.BROADCAST_SPANS, 0])
def test_corpus(spark, corpus, docs, monkeypatch, few):
    monkeypatch.setattr(S, "BROADCAST_SPANS", few)
    odd = docs.withColumn("kept", F.lit(1)).withColumn("t1", F.lit("x"))
    assert found(odd, 400) == {r[0]: w for r, w in zip(corpus, brute([r[1] for r in corpus], 400), strict=True)}


def test_parts_of_long_texts(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 37)
    rng = random.Random(3)
    for length in (20, 64):
        data = np.frombuffer("".join(rng.choices("abc", k=900)).encode(), np.uint8)
        for width in S.widths(length)[:2]:
            first, last, _, _ = S.text_blocks(data, width, length)
            assert [i for a, b in zip(first, last) for i in range(a, b + 1)] == list(range(len(data) - length + 1))


@pytest.mark.parametrize("piece", [100, S.PIECE])
@pytest.mark.parametrize("length", [20, 51, 64])
def test_blocks_of_many_texts_at_once(length, piece, monkeypatch):
    monkeypatch.setattr(S, "PIECE", piece)
    rng = random.Random(length)
    sizes = [0, 3, length - 1, length, 0, 400, length + 1, 1, 90, 0]
    for alphabet in ("abc", "a", "abcdefgh"):
        texts = [np.frombuffer("".join(rng.choices(alphabet, k=n)).encode(), np.uint8) for n in sizes]
        data, bounds = np.concatenate(texts), np.cumsum([0, *sizes])
        for width in S.widths(length)[:2]:
            text, *found = S.block_blocks(data, bounds, width, length)
            for k, own in enumerate(texts):
                for x, y in zip(found, S.text_blocks(own, width, length), strict=True):
                    assert x[text == k].tolist() == y.tolist()
    assert [len(x) for x in S.block_blocks(data[:0], np.array([0, 0]), 4, length)] == [0] * 5


def test_readable_texts(spark):
    passage = "é" * 250
    rows = [(1, "xé" + passage + " ende", None, None, None), (2, passage, None, None, None), (3, None, None, None, None), (4, "", None, None, None)]
    left = {r.doc_id: r.text for r in S.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}
    assert left[3] is None and left[4] == "" and left[2] == "" and left[1].endswith(" ende") and left[1].startswith("x")


def test_repeated_rows_and_empty_table(spark, empty):
    text = prose(random.Random(4), 150)
    df = spark.createDataFrame([(1, text, None, None, None)] * 3 + [(2, text[:100], None, None, None)], DOCS)
    assert [len(r.kept) for r in S.without_repeats(df).orderBy("doc_id").collect()] == [0, 0, 0, len(text[:100].encode())]
    assert S.without_repeats(empty).count() == 0


def test_all_texts_shuffled(spark, corpus, docs, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_SPANS", 0)
    monkeypatch.setattr(S, "BROADCAST_TEXTS", 0)
    assert found(docs, 400) == {r[0]: w for r, w in zip(corpus, brute([r[1] for r in corpus], 400), strict=True)}


def test_texts_without_spans_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_SPANS", 0)
    texts = spark.createDataFrame([(k % 3, k, f"text {k}") for k in range(9)], "t1 long, t2 long, text string")
    pair = "array<struct<first: long, last: long>>"
    ranges = spark.createDataFrame([(1, 4, [(0, 5)], None)], f"t1 long, t2 long, a {pair}, b {pair}")
    joined = S._joined(texts, ranges, "left")
    assert "LeftAnti, BuildRight" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.t2, r.text, r.a is not None) for r in joined.collect()) == [(k, f"text {k}", k == 4) for k in range(9)]
    assert [(r.t2, r.a[0].last, r.b) for r in S._joined(texts, ranges, "inner").collect()] == [(4, 5, None)]


def test_a_passage_is_one_range(spark):
    rng = random.Random(12)
    passage, own = prose(rng, 200), [prose(rng, 150) for _ in range(4)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]} {passage} {own[3]}", passage[:-7]]
    keyed = spark.createDataFrame([(t,) for t in texts], "text string").select(*S.digests(F.col("text")), "text")
    assert [len(r.ranges) for r in S._starts(keyed, 400, False).collect()] == [1, 1, 1]


def brute_passages(texts, words):
    data = [(t or "").encode() for t in texts]
    found = [[(m[0], m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    runs = [[tuple(w[0] for w in f[i : i + words]) for i in range(len(f) - words + 1)] for f in found]
    seen = collections.Counter(r for own in runs for r in own)
    out = []
    for f, own in zip(found, runs, strict=True):
        spans = []
        for i, run in enumerate(own):
            if seen[run] > 1:
                low, high = f[i][1], f[i + words - 1][2] - 1
                if spans and low <= spans[-1][1] + 1:
                    spans[-1][1] = high
                else:
                    spans.append([low, high])
        out.append([tuple(x) for x in spans])
    return out


@pytest.mark.parametrize("few", [S.BROADCAST_SPANS, 0])
def test_short_passages_are_told_beside_the_strings(spark, corpus, tmp_path, monkeypatch, few):
    monkeypatch.setattr(S, "BROADCAST_SPANS", few)
    rng = random.Random(21)
    short, fifty = prose(rng, 51, ("ab", "c", "é")), prose(rng, 50, ("de", "f", "ü"))
    own = [prose(rng, 20) for _ in range(6)]
    texts = [f"{own[0]} {short} {own[1]}", f"{own[2]}\n{short.replace(' ', '\n ')}", f"{fifty} {own[3]}", f"{own[4]} {fifty}", f"{short} {short}", own[5]]
    texts = [r[1] for r in corpus] + texts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    want = [(*b, len(p), sum(y - x + 1 for x, y in p)) for b, p in zip(brute(texts, 400), brute_passages(texts, 51), strict=True)]
    assert [w[1:5:3] for w in want[-6:-4]] == [(0, 1), (0, 1)] and [w[4] for w in want[-4:]] == [0, 0, 2, 0]
    rows = queries.op10_repeated_strings(spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == dict(enumerate(want))


def test_passages_are_cut_or_only_told(spark, corpus, docs):
    told = {r.doc_id: r for r in S.without_repeats(docs.withColumn("passages", F.lit(1)), words=51, cut_words=False).collect()}
    cut = {r.doc_id: r for r in S.without_repeats(docs, words=51).collect()}
    plain = {r.doc_id: r for r in S.without_repeats(docs).collect()}
    for (k, *_), want in zip(corpus, brute_passages([r[1] for r in corpus], 51), strict=True):
        assert [tuple(x) for x in told[k].passages] == [tuple(x) for x in cut[k].passages] == want
        assert told[k].removed == plain[k].removed and told[k].kept == plain[k].kept
        assert len(cut[k].kept) <= len(plain[k].kept)
    assert S.without_repeats(docs).columns == [*docs.columns, "n_bytes", "removed", "kept"]
