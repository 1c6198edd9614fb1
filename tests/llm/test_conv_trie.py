"""The trie against one built by joining rebuilt turns, on small tables with every odd case."""

import collections
import random
import zlib

import pytest
from conftest_llm import sha
from pyspark.sql import functions as F

from tierworks.llm import conv_trie, queries
from tierworks.plans import plan_text

SCHEMA = "conv_id long, turn long, role string, text string, c long, depth string, k1 string"


def rows_of(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.choice([0, 1, 2, 3, 7, 99, 100, 101, 205, 206, 300, -5, -100])
        turn = rng.choice([None, 0, 1, 2, 2, 3, 4, 5, 6])
        rows.append((conv, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "", None, "día 🙂"])))
    rows += [(500 + k, t, "user", "same") for k in range(40) for t in range(3)]  # copies
    rows += [(702, t, "user", "x" * (t + 1)) for t in range(60)]  # a long one
    rows += [(None, 1, "user", "lost"), (901, 0, None, None)]
    return [(*r, 5, "mine", "mine") for r in rows]


def brute(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, v in own.items()}
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(c - rest, [])[:h] + seq[h:])
    members = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    out = []
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        saved = sum((len(members[k]) - 1) * (len(k[-1][1]) if k else 0) for k in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(key))
        up = min(members[key[:-1]]) if key else None
        out.append((min(convs), len(key), up, len(convs), children[key], sum(not children[k] for k in below), saved, sha(ends.encode())))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in conv_trie.prefix_trie(df, **options).drop("last_conv_id", "last_place").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_joined_turns(spark, seed):
    rows = rows_of(seed)
    assert found(spark, rows) == brute(rows)


def test_large_conversations_are_cut(spark):
    rows = rows_of(3)
    assert found(spark, rows, rows_per_task=20) == brute(rows)


def test_runs_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "RUN_BITS", 2)
    rows = rows_of(4, n=40)
    assert found(spark, rows) == brute(rows)


def test_equal_hashes_are_noticed(spark):
    """With contents hashed to a handful of values the first try must fail its checks."""
    rows = rows_of(5, n=60)
    turns = conv_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text", 0, 3, None)
    assert not conv_trie._equal_contents(turns)
    assert found(spark, rows, modulus=3) == brute(rows)


def test_reference_of_the_last_turn(spark):
    rows = [(100, 0, "u", "head", 0, "", ""), (100, 1, "u", "next", 0, "", ""), (101, 0, "u", "own", 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = conv_trie.prefix_trie(df, head=lambda c: F.lit(1)).collect()
    refs = {(r.depth, r.conv_id): (r.last_conv_id, r.last_place) for r in nodes}
    assert refs == {(0, 100): (None, None), (1, 100): (100, 1), (2, 100): (100, 2)}


def test_empty_table(spark):
    assert found(spark, []) == []


def test_turnless_conversations_end_in_the_root(spark):
    """101 passes over its only turn, and its base is not there."""
    assert zlib.crc32(b"101") % 6 > 0
    assert found(spark, [(101, 0, "u", "gone", 0, "", "")]) == [(101, 0, None, 1, 0, 1, 0, sha(b"101"))]


def test_sql(spark):
    from oracle import connect, differences

    sf_dir = "/root/testdata/sf0.01"
    sql = queries.oracle_sql()["op13_conversation_trie"]
    assert differences(queries.op13_conversation_trie(spark, sf_dir), connect(sf_dir), sql) == ""


def test_texts_are_read_for_hashes_only(spark):
    """Nothing behind the stored turns carries a text."""
    turns = conv_trie.settle(conv_trie.numbered_turns(spark.createDataFrame(rows_of(6), SCHEMA), "conv_id", "turn", "role", "text", 0, conv_trie.P, None))
    c = F.col("c")
    convs = conv_trie.heads(turns, conv_trie.base_of_hundred(c), conv_trie.head_by_crc(c))
    assert "text" not in conv_trie.rebuilt_prefixes(turns, convs, 0).columns
    assert "CartesianProduct" not in plan_text(convs)
