import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tierworks.operators.dimension import StoredDimension
from tierworks.operators.scd2 import scd2_apply
from tierworks.sources.listing import write_text

KEY, TRACKED = ["id"], ["segment", "region"]
CUSTOMER = "id bigint, name string, segment string, region string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


def test_equals_applying_in_memory(spark, tmp_path):
    rng = random.Random(8)
    stored = StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED, buckets=5)
    assert stored.read() is None and stored.current() is None
    dim = None
    for n in range(4):
        batch = frame(spark, [(i, f"n{rng.random()}", rng.choice(["smb", "mid", None]), rng.choice(["na", None])) for i in rng.sample(range(60), 30)])
        dim = scd2_apply(dim, batch, KEY, TRACKED, day(n)).checkpoint()
        assert stored.apply(batch, day(n))
        assert rows_of(stored.read().select(*dim.columns)) == rows_of(dim)
        assert rows_of(stored.current().select(*dim.columns)) == rows_of(dim.filter("is_current"))


def test_a_batch_id_counts_once(spark, tmp_path):
    stored = StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED)
    batch = frame(spark, [(1, "a", "smb", "na")])
    assert stored.apply(batch, day(0), "first") and not stored.apply(batch, day(1), "first")
    assert StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED).table.has("first")
    assert not stored.table.has("second")
    assert stored.read().count() == 1


def test_null_keys_are_kept_apart(spark, tmp_path):
    stored = StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED)
    stored.apply(frame(spark, [(1, "a", "smb", "na"), (None, "x", "smb", "na")]), day(0))
    stored.apply(frame(spark, [(None, "y", "smb", "na")]), day(1))
    assert rows_of(stored.rejected().select("name")) == [("x",), ("y",)] and stored.read().count() == 1


def test_a_failed_batch_leaves_the_table(spark, tmp_path):
    stored = StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED, buckets=3)
    stored.apply(frame(spark, [(i, "a", "smb", "na") for i in range(9)]), day(0))
    before = rows_of(stored.read())
    for rows, as_of, words in ([(1, "a", "x", "na"), (1, "a", "y", "na")], day(1), "duplicate key"), ([(1, "a", "x", "na")], day(0), "not after"):
        with pytest.raises(Exception, match=words):
            stored.apply(frame(spark, rows), as_of)
    # Closed versions of a batch that got no further.
    spark.createDataFrame([(1, "a")], "id bigint, name string").write.parquet(f"{tmp_path}/d/closed/version={2:012d}")
    assert rows_of(StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED).read()) == before
    write_text(spark, stored.table._note("lost"), "2")
    stored.apply(frame(spark, [(1, "a", "smb", "na")]), day(1), "other")
    assert not stored.table.has("lost") and stored.table.has("other")
    assert rows_of(StoredDimension(spark, str(tmp_path / "d"), KEY, TRACKED).read()) == before
    stored.apply(frame(spark, [(1, "a", "x", "na")]), day(2))
    assert stored.read().count() == 10


def test_a_small_batch_costs_the_same_whatever_the_history(spark, tmp_path):
    root = str(tmp_path / "d")
    stored = StoredDimension(spark, root, KEY, TRACKED, buckets=32)
    everyone = spark.range(3000).select("id", F.lit("n").alias("name"), F.lit("s0").alias("segment"), F.lit("na").alias("region"))
    stored.apply(everyone, day(0))
    added = {}
    for n in range(1, 6):
        before = size(root)
        batch = frame(spark, [(7, "n", f"small{n}", "na")]) if n in (1, 5) else everyone.withColumn("segment", F.lit(f"s{n}"))
        stored.apply(batch, day(2 * n))
        added[n] = size(root) - before
    assert stored.read().count() == 3000 + 1 + 3 * 3000 + 1
    assert added[5] < 1.2 * added[1] and added[5] < added[4] / 4
    written = [sum(1 for _ in os.scandir(f"{root}/data/version={n:012d}") if _.name.startswith("_bucket=")) for n in (2, 6)]
    assert written == [1, 1]


def test_an_unchanged_batch_rewrites_nothing(spark, tmp_path):
    root = str(tmp_path / "d")
    stored = StoredDimension(spark, root, KEY, TRACKED, buckets=4)
    batch = frame(spark, [(i, "a", "smb", "na") for i in range(20)])
    stored.apply(batch, day(0))
    stored.apply(batch, day(1))
    assert not os.path.exists(f"{root}/data/version={2:012d}") and rows_of(stored.read())[0][4] == day(0)
