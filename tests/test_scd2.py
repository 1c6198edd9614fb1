import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from tierworks.operators.scd2 import (
    first_versions,
    join_as_of,
    one_row_per_key,
    scd2_apply,
    scd2_as_of,
    scd2_current,
    scd2_rebuild,
    scd2_snapshot,
    split_null_keys,
)
from tierworks.plans import sizing

KEY, TRACKED = ["id"], ["segment", "region"]
CUSTOMER = "id bigint, name string, segment string, region string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=["small batch", "large batch"])
def either_size(request, monkeypatch):
    """Run a test once with the batch broadcast and once with the full outer join."""
    if request.param == "large batch":
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)


def test_change_closes_and_opens(spark, either_size):
    start = first_versions(frame(spark, [(1, "a", "smb", "na"), (2, "b", "mid", "na")]), KEY, day(0))
    after = scd2_apply(start, frame(spark, [(1, "a", "ent", "na"), (3, "c", "smb", "na")]), KEY, TRACKED, day(1))
    assert rows_of(after) == sorted(
        [
            (1, "a", "smb", "na", day(0), day(1), False),
            (1, "a", "ent", "na", day(1), None, True),
            (2, "b", "mid", "na", day(0), None, True),
            (3, "c", "smb", "na", day(1), None, True),
        ],
        key=repr,
    )


def test_untracked_change_is_no_version(spark, either_size):
    start = first_versions(frame(spark, [(1, "a", "smb", "na")]), KEY, day(0))
    after = scd2_apply(start, frame(spark, [(1, "renamed", "smb", "na")]), KEY, TRACKED, day(1))
    assert rows_of(after) == [(1, "a", "smb", "na", day(0), None, True)]


@pytest.mark.parametrize("before,later", [(None, "na"), ("na", None)])
def test_null_changes(spark, before, later, either_size):
    start = first_versions(frame(spark, [(1, "a", "smb", before)]), KEY, day(0))
    batch = frame(spark, [(1, "a", "smb", later)])
    assert scd2_apply(start, batch, KEY, TRACKED, day(1)).count() == 2
    # Compared with <>, a change from or to NULL goes unnoticed, unless another column changes too.
    assert scd2_apply(start, batch, KEY, TRACKED, day(1), null_safe=False).count() == 1
    both = frame(spark, [(1, "a", "ent", later)])
    assert scd2_apply(start, both, KEY, TRACKED, day(1), null_safe=False).count() == 2


def test_null_keys_are_split_off(spark, either_size):
    batch = frame(spark, [(None, "x", "smb", "na"), (1, "a", "smb", "na")])
    good, quarantine = split_null_keys(batch, KEY)
    assert good.count() == 1 and quarantine.count() == 1
    start = first_versions(batch, KEY, day(0))
    assert scd2_apply(start, batch, KEY, TRACKED, day(1)).count() == 1


def test_duplicate_keys_fail(spark):
    start = first_versions(frame(spark, [(1, "a", "smb", "na")]), KEY, day(0))
    twice = frame(spark, [(2, "a", "smb", "na"), (2, "a", "ent", "na")])
    with pytest.raises(Exception, match="duplicate key"):
        scd2_apply(start, twice, KEY, TRACKED, day(1)).count()
    with pytest.raises(Exception, match="duplicate key"):
        one_row_per_key(twice, KEY).count()


def test_close_missing(spark, either_size):
    start = first_versions(frame(spark, [(1, "a", "smb", "na"), (2, "b", "mid", "na")]), KEY, day(0))
    batch = frame(spark, [(1, "a", "smb", "na")])
    assert scd2_current(scd2_apply(start, batch, KEY, TRACKED, day(1))).count() == 2
    closed = scd2_apply(start, batch, KEY, TRACKED, day(1), close_missing=True)
    assert rows_of(scd2_current(closed)) == [(1, "a", "smb", "na", day(0), None, True)]
    # A key that comes back gets a new version.
    again = scd2_apply(closed, frame(spark, [(2, "b", "mid", "na")]), KEY, TRACKED, day(2))
    assert again.filter("id = 2").count() == 2


def test_same_as_two_merges(spark, either_size):
    """The rule of the two-statement form: expire changed rows, then insert what has no current row."""
    rng = random.Random(3)
    make = lambda ids: [
        (i, f"n{rng.random()}", rng.choice(["smb", "mid", None]), rng.choice(["na", "emea", None])) for i in ids
    ]
    dim, expected = None, []
    for n in range(4):
        batch = make(rng.sample(range(60), 40))
        incoming = {r[0]: r for r in batch}
        if expected:
            for row in expected:
                new = incoming.get(row[0])
                if row[6] and new and (row[2], row[3]) != (new[2], new[3]):
                    row[5], row[6] = day(n), False
        live = {r[0] for r in expected if r[6]}
        expected += [[*incoming[i], day(n), None, True] for i in incoming if i not in live]
        dim = scd2_apply(dim, frame(spark, batch), KEY, TRACKED, day(n)).checkpoint()
        assert rows_of(dim) == sorted(map(tuple, expected), key=repr)


def history(spark, seed=5, keys=40, batches=6):
    rng = random.Random(seed)
    log = [
        (i, f"n{i}", rng.choice(["smb", "mid"]), rng.choice(["na", None]), day(n))
        for n in range(batches)
        for i in rng.sample(range(keys), keys * 2 // 3)
    ]
    return spark.createDataFrame(log, f"{CUSTOMER}, batch_ts timestamp")


def fold(log):
    dim = None
    for (ts,) in log.select("batch_ts").distinct().orderBy("batch_ts").collect():
        batch = log.filter(F.col("batch_ts") == F.lit(ts)).drop("batch_ts")
        dim = scd2_apply(dim, batch, KEY, TRACKED, ts).checkpoint()
    return dim


@pytest.mark.parametrize("rows_per_task", [None, 3])
def test_rebuild_equals_fold_and_intervals_do_not_overlap(spark, rows_per_task):
    log = history(spark)
    rebuilt = scd2_rebuild(log, KEY, TRACKED, "batch_ts", rows_per_task)
    folded = fold(log)
    assert rows_of(rebuilt.select(*folded.columns)) == rows_of(folded)
    by_time = Window.partitionBy("id").orderBy("effective_from")
    gaps = folded.withColumn("next", F.lead("effective_from").over(by_time)).filter(
        ~F.col("next").eqNullSafe(F.col("effective_to"))
    )
    assert gaps.count() == 0
    assert folded.filter("is_current").groupBy("id").count().filter("count <> 1").count() == 0


def test_return_to_an_earlier_value_gives_three_versions(spark):
    log = spark.createDataFrame(
        [(1, "a", s, "na", day(n)) for n, s in enumerate(["smb", "ent", "smb", "smb"])],
        f"{CUSTOMER}, batch_ts timestamp",
    )
    assert scd2_rebuild(log, KEY, TRACKED, "batch_ts").count() == 3
    assert fold(log).count() == 3


def test_rebuild_refuses_two_rows_of_a_batch(spark):
    log = history(spark, batches=1)
    with pytest.raises(Exception, match="two rows of one key"):
        scd2_rebuild(log.union(log), KEY, TRACKED, "batch_ts").count()


def test_idempotent(spark, either_size):
    log = history(spark)
    dim = fold(log)
    last = log.filter(F.col("batch_ts") == F.lit(day(5))).drop("batch_ts")
    assert rows_of(scd2_apply(dim, last, KEY, TRACKED, day(9))) == rows_of(dim)


def test_snapshot_names_and_surrogate(spark):
    first = scd2_snapshot(None, frame(spark, [(1, "a", "smb", "na")]), KEY, TRACKED, day(0))
    second = scd2_snapshot(first, frame(spark, [(1, "a", "ent", "na")]), KEY, TRACKED, day(1))
    assert set(second.columns) == {"id", "name", "segment", "region", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"}
    assert second.filter("dbt_valid_to IS NULL").select("segment").first()[0] == "ent"
    assert second.select("dbt_scd_id").distinct().count() == 2
    kept = second.filter("dbt_valid_to IS NOT NULL").select("dbt_scd_id").first()
    assert kept == first.select("dbt_scd_id").first()


def test_as_of_is_half_open(spark):
    start = first_versions(frame(spark, [(1, "a", "smb", "na")]), KEY, day(0))
    dim = scd2_apply(start, frame(spark, [(1, "a", "ent", "na")]), KEY, TRACKED, day(1))
    assert scd2_as_of(dim, day(1)).select("segment").first()[0] == "ent"
    assert scd2_as_of(dim, day(0)).select("segment").first()[0] == "smb"
    assert scd2_as_of(dim, day(-1)).count() == 0


@pytest.mark.parametrize("broadcast,rows_per_task", [(None, None), (True, None), (False, None), (False, 5)])
def test_join_as_of_by_bisection_and_by_order_agree(spark, broadcast, rows_per_task):
    log = history(spark, keys=9, batches=20)
    dim = scd2_rebuild(log, KEY, TRACKED, "batch_ts").checkpoint()
    # A gap: some versions end before the next one starts.
    dim = dim.withColumn(
        "effective_to",
        F.when((F.col("id") % 3 == 0) & F.col("effective_to").isNotNull(), F.col("effective_from") + F.expr("INTERVAL 5 HOURS"))
        .otherwise(F.col("effective_to")),
    )
    # Empty versions are never valid: one that ends when it begins, one without a start.
    odd = dim.limit(3).withColumn("effective_to", F.col("effective_from"))
    dim = dim.unionByName(odd).unionByName(odd.withColumn("effective_from", F.lit(None).cast("timestamp"))).checkpoint()
    facts = spark.createDataFrame(
        [(n, n % 11 if n % 13 else None, day(0) + dt.timedelta(hours=7 * (n % 71)) if n % 17 else None) for n in range(400)],
        "fact bigint, customer bigint, at timestamp",
    )
    expected = facts.join(
        dim, (F.col("customer") == F.col("id")) & (F.col("effective_from") <= F.col("at"))
        & (F.col("effective_to").isNull() | (F.col("at") < F.col("effective_to"))),
    ).select("fact", "segment", "region", "effective_from")
    got = join_as_of(facts, dim, "customer", "id", "at", broadcast=broadcast, rows_per_task=rows_per_task)
    assert rows_of(got.select(*expected.columns)) == rows_of(expected)
    assert expected.count() > 100


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("first_end", [None, 5])
def test_overlapping_versions_fail_either_way(spark, broadcast, first_end):
    versions = [(1, "a", day(0), day(first_end) if first_end else None), (1, "b", day(3), None)]
    dim = spark.createDataFrame(versions, "id bigint, v string, effective_from timestamp, effective_to timestamp")
    facts = spark.createDataFrame([(1, day(4))], "customer bigint, at timestamp")
    with pytest.raises(Exception, match="overlapping versions"):
        join_as_of(facts, dim, "customer", "id", "at", broadcast=broadcast).collect()


def test_as_of_must_follow_the_standing_version(spark):
    dim = first_versions(spark.createDataFrame([(1, "a", "x")], "id bigint, segment string, region string"), ["id"], F.lit(day(5)))
    changed = spark.createDataFrame([(1, "b", "x")], "id bigint, segment string, region string")
    for moment in (day(4), day(5)):
        with pytest.raises(Exception, match="as_of is not after"):
            scd2_apply(dim, changed, ["id"], ["segment", "region"], F.lit(moment)).collect()
    assert scd2_apply(dim, changed, ["id"], ["segment", "region"], F.lit(day(6))).count() == 2


def test_surrogates_keep_key_parts_apart(spark):
    rows = spark.createDataFrame([("a|b", "c", "x"), ("a", "b|c", "x")], "k string, l string, v string")
    made = scd2_snapshot(None, rows, ["k", "l"], ["v"], F.lit(day(0)))
    assert made.select("dbt_scd_id").distinct().count() == 2
