import random

import pytest
from pyspark.sql import functions as F

from tierworks.operators.cdc import ChangedTable, change_state, fold_changes, live_rows, merge_states, split_changes, tombstones
from tierworks.plans import plan_text

SCHEMA = "sku string, qty int, note string, op string, ts int, nr int"
KEY, ORDER, OP = ["sku"], ["ts", "nr"], "op"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def in_turn(rows):
    """The fold, one change after the other."""
    live, seen = {}, set()
    for sku, qty, note, op, *_ in sorted(set(rows), key=lambda r: (r[4], r[5])):
        if op == "insert":
            live[sku] = [qty, note]
        elif op == "delete":
            live.pop(sku, None)
        elif sku in live or sku not in seen:
            row = live.setdefault(sku, [None, None])
            row[0], row[1] = (qty if qty is not None else row[0]), (note if note is not None else row[1])
        seen.add(sku)
    return sorted(((k, *v) for k, v in live.items()), key=repr)


def log(seed, n=300):
    rng = random.Random(seed)
    skus = ["hot"] * 6 + [f"s{k}" for k in range(12)]
    rows = [
        (rng.choice(skus), rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice(["insert", "update", "update", "delete"]), rng.randint(0, 40), k)
        for k in range(n)
    ]
    return rows + rng.sample(rows, n // 5)


@pytest.mark.parametrize("seed", range(4))
def test_equals_one_change_after_the_other(spark, seed):
    rows = log(seed)
    random.Random(seed).shuffle(rows)
    assert rows_of(fold_changes(frame(spark, rows), KEY, ORDER, OP)) == in_turn(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_any_batches_in_any_order(spark, tmp_path, seed):
    rows = log(seed, n=120)
    rng = random.Random(seed)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(len(rows)), 3))
    stored = ChangedTable(spark, str(tmp_path / "t"), KEY, ORDER, OP, buckets=4)
    assert stored.read() is None
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    for batch in [*batches, batches[0]]:  # the first one twice
        assert stored.apply(frame(spark, batch)).count() == 0
    assert rows_of(stored.read()) == in_turn(rows)
    # The folder opened anew knows its buckets.
    assert ChangedTable(spark, str(tmp_path / "t"), KEY, ORDER, OP, buckets=99).table.buckets == 4


def test_late_changes_meet_tombstones(spark):
    first = frame(spark, [("a", 1, "x", "insert", 1, 1), ("a", None, None, "delete", 5, 2)])
    late = frame(spark, [("a", 9, None, "update", 3, 3), ("a", 7, None, "update", 6, 4)])
    state = merge_states(change_state(first, KEY, ORDER, OP).unionByName(change_state(late, KEY, ORDER, OP)), KEY)
    assert rows_of(live_rows(state, KEY)) == []
    assert [(r.sku, tuple(r.deleted_at)) for r in tombstones(state, KEY).collect()] == [("a", (5, 2))]
    again = change_state(frame(spark, [("a", 2, None, "insert", 8, 5)]), KEY, ORDER, OP)
    assert rows_of(live_rows(merge_states(state.unionByName(again), KEY), KEY)) == [("a", 2, None)]


def test_delete_wins_a_tie(spark):
    rows = [("a", 1, "x", "insert", 1, 1), ("a", None, None, "delete", 1, 1)]
    assert rows_of(fold_changes(frame(spark, rows), KEY, ORDER, OP)) == []


def test_unusable_changes_are_returned_or_fail(spark, tmp_path):
    rows = [(None, 1, "x", "insert", 1, 1), ("a", 1, "x", "what", 1, 1), ("a", 1, "x", None, None, 1), ("a", 1, "x", "INSERT", 1, 1)]
    good, bad = split_changes(frame(spark, rows), KEY, ORDER, OP)
    assert good.count() == 1
    assert sorted(r._reject_reason for r in bad.collect()) == ["op: no kind of change", "sku: missing", "ts: missing; op: no kind of change"]
    with pytest.raises(Exception, match="without key, order or known kind"):
        change_state(frame(spark, rows), KEY, ORDER, OP).collect()
    stored = ChangedTable(spark, str(tmp_path / "t"), KEY, ORDER, OP)
    assert stored.apply(frame(spark, rows)).count() == 3 and rows_of(stored.read()) == [("a", 1, "x")]


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = [("hot", k, "n", "update", k, k) for k in range(500)]
    text = plan_text(fold_changes(frame(spark, rows).repartition(4), KEY, ORDER, OP))
    assert "partial_max" in text


def test_interrupted_batch_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path / "t")
    stored = ChangedTable(spark, root, KEY, ORDER, OP, buckets=3)
    stored.apply(frame(spark, [(f"s{k}", k, "n", "insert", 1, k) for k in range(20)]))
    before = rows_of(stored.read())
    broken = frame(spark, [("s1", 5, "n", "update", 2, 1)]).withColumn("qty", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        stored.apply(broken)
    # Data of a version whose log was never written.
    spark.range(3).write.parquet(f"{root}/data/version={2:012d}/_bucket=0")
    assert rows_of(ChangedTable(spark, root, KEY, ORDER, OP).read()) == before
    stored.apply(frame(spark, [("s1", 5, None, "update", 2, 1)]))
    assert ("s1", 5, "n") in rows_of(stored.read()) and len(rows_of(stored.read())) == 20


def test_column_that_comes_later(spark, tmp_path):
    stored = ChangedTable(spark, str(tmp_path / "t"), KEY, ORDER, OP, buckets=2)
    stored.apply(frame(spark, [("a", 1, "x", "insert", 1, 1), ("b", 1, "x", "insert", 1, 1)]))
    stored.apply(frame(spark, [("a", 2, None, "update", 2, 1)]).withColumn("shelf", F.lit("top")))
    assert {r.sku: (r.qty, r.note, r.shelf) for r in stored.read().collect()} == {"a": (2, "x", "top"), "b": (1, "x", None)}
