import random

import pytest
from pyspark.sql import Window, functions as F

from tierworks.functions import MONEY
from tierworks.operators.aggregates import batch_audit, revenue_by, rows_by, with_rank_and_share
from tierworks.operators.benchmark import medians_by
from tierworks.operators.windows import (
    group_max_and_delta,
    newest_per_key,
    period_change,
    running_total,
    top_per_group,
)
from tierworks.plans import sizing
from tierworks.plans.skew import OrderedGroups, large_groups

SPLIT = [None, 40]  # groups in one task, or cut into cells


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with more than a third of the rows, a NULL group, NULL and tied measures."""
    rng = random.Random(11)
    groups = ["hot"] * 8 + ["a", "b", "c", None, "d", "e", "f"]
    rows = [
        (n, rng.choice(groups), rng.choice([None, *[round(rng.uniform(0, 99), 2)] * 3, 50.0]), rng.choice([None, *range(90)]))
        for n in range(600)
    ]
    return spark.createDataFrame(rows, "id bigint, part string, x double, moment int").checkpoint()


def test_large_groups_are_found(skewed):
    assert [r["part"] for r in large_groups(skewed, ["part"], 200).df.collect()] == ["hot"]
    assert large_groups(skewed, ["part"], 100_000).rows == 0
    assert large_groups(skewed, [], 100).rows == 1
    ordered = OrderedGroups(skewed, ["part"], ["id"], 40)
    cells = ordered.rows.groupBy("part", "_cell").count()
    assert cells.filter("part = 'hot'").count() > 4 and cells.agg(F.max("count")).first()[0] < 160


@pytest.mark.parametrize("rows", SPLIT)
@pytest.mark.parametrize("part", [["part"], []])
def test_running_total(skewed, rows, part):
    order = [F.col("moment").asc_nulls_last(), F.col("id").asc_nulls_last()]
    window = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = skewed.withColumn("running_total", F.sum(F.col("x").cast("decimal(18,2)")).over(window).cast("double"))
    got = running_total(skewed, part, ["moment", "id"], "x", rows_per_task=rows, sum_type=MONEY)
    assert rows_of(got, *want.columns) == rows_of(want)


@pytest.mark.parametrize("rows", SPLIT)
def test_period_change(skewed, rows):
    window = Window.partitionBy("part").orderBy(F.col("moment").asc_nulls_last(), "id")
    want = skewed.withColumn("period_change", F.col("x") - F.lag("x").over(window))
    got = period_change(skewed, ["part"], ["moment", "id"], "x", rows_per_task=rows)
    assert rows_of(got, *want.columns) == rows_of(want)


@pytest.mark.parametrize("rows", SPLIT)
def test_neighbours_and_last_seen_after_a_filter(skewed, rows):
    """Cells that a filter empties must be skipped by what is carried over."""
    kept = F.col("id") % 50 < 2
    window = Window.partitionBy("part").orderBy("id")
    value = F.struct("id")
    want = (
        skewed.filter(kept)
        .withColumn("next", F.lead(value).over(window))
        .withColumn("seen", F.last(F.when(F.col("x") > 60, F.col("x")), ignorenulls=True).over(window))
    )
    ordered = OrderedGroups(skewed, ["part"], ["id"], rows)
    got = ordered.neighbour(ordered.rows.filter(kept), value, "next", following=True)
    got = ordered.last_seen(got, F.when(F.col("x") > 60, F.col("x")), "seen")
    assert rows_of(got, *want.columns) == rows_of(want)


@pytest.mark.parametrize("rows", SPLIT)
@pytest.mark.parametrize("k", [1, 3])
def test_top_per_group_keeps_ties(skewed, rows, k):
    window = Window.partitionBy("part").orderBy(F.col("x").desc_nulls_last())
    want = skewed.withColumn("rnk", F.dense_rank().over(window)).filter(F.col("rnk") <= k)
    got = top_per_group(skewed, ["part"], "x", k, rows_per_task=rows)
    assert rows_of(got, *want.columns) == rows_of(want)


def test_top_per_group_of_nulls_only(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None)], "part string, x double")
    for rows in (None, 1):
        assert rows_of(top_per_group(df, ["part"], "x", rows_per_task=rows)) == [("a", None, 1), ("a", None, 1), ("b", 1.0, 1)]


@pytest.mark.parametrize("rows", SPLIT)
def test_group_max_and_delta(skewed, rows):
    window = Window.partitionBy("part")
    average = F.sum(F.col("x").cast("decimal(18,2)")).over(window).cast("double") / F.count("x").over(window)
    want = skewed.withColumn("group_max", F.max("x").over(window)).withColumn("delta_from_avg", F.col("x") - average)
    got = group_max_and_delta(skewed, ["part"], "x", rows_per_task=rows, sum_type=MONEY)
    assert rows_of(got, *want.columns) == rows_of(want)


def test_newest_per_key_breaks_ties_by_all_columns(spark):
    rows = [(1, "2024-01-01", "b1", "x"), (1, "2024-01-02", "b1", "y"), (1, "2024-01-02", "b2", "p"), (1, "2024-01-02", "b2", "q"), (2, None, "b1", "z")]
    df = spark.createDataFrame(rows, "id int, at string, batch string, v string")
    want = [(1, "2024-01-02", "b2", "q"), (2, None, "b1", "z")]
    assert rows_of(newest_per_key(df, ["id"], ["at", "batch"])) == want
    assert rows_of(newest_per_key(df.orderBy(F.rand()), ["id"], ["at", "batch"])) == want


@pytest.mark.parametrize("rows", [None, 30])
def test_medians(skewed, rows):
    want = skewed.groupBy("part").agg(F.median("x").alias("x"), F.median("moment").alias("moment"))
    assert rows_of(medians_by(skewed, ["part"], ["x", "moment"], rows)) == rows_of(want)


@pytest.mark.parametrize("one_task", [None, 10])
def test_rank_and_share(skewed, one_task):
    df = skewed.select("id", "x")
    want = df.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("x").desc_nulls_last())))
    got = with_rank_and_share(df, "x", one_task_rows=one_task, sum_type=MONEY)
    assert rows_of(got, "id", "revenue_rank") == rows_of(want, "id", "revenue_rank")
    assert abs(got.agg(F.sum("revenue_share")).first()[0] - 1) < 1e-6


def test_share_of_zero_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "k string, x double")
    assert rows_of(with_rank_and_share(df, "x")) == [("a", 0.0, 1, None), ("b", 0.0, 1, None)]


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_revenue_by(spark, monkeypatch, broadcast_rows):
    if broadcast_rows is not None:
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", broadcast_rows)
    facts = spark.createDataFrame([(1, 10.1), (1, 20.2), (2, 5.0), (None, 7.0), (9, 1.0)], "customer_id int, amount double")
    dim = spark.createDataFrame(
        [(1, "smb", False), (1, "ent", True), (2, "smb", True), (None, "smb", True)], "id int, segment string, is_current boolean"
    )
    assert rows_of(revenue_by(facts, dim, "segment")) == [("ent", 30.3), ("smb", 5.0)]
    assert rows_of(revenue_by(facts, dim, "segment", current_only=False)) == [("ent", 30.3), ("smb", 35.3)]
    assert rows_of(revenue_by(facts, dim, "segment", where=F.col("segment") == "smb", fact_where=F.col("amount") < 5)) == []
    fine = spark.createDataFrame([(2, 0.0625), (2, 0.0625)], "customer_id int, amount double")
    assert rows_of(revenue_by(fine, dim, "segment", sum_type="decimal(20,6)")) == [("smb", 0.125)]
    assert rows_of(revenue_by(fine, dim, "segment", sum_type=None)) == [("smb", 0.125)]
    by_id = dim.withColumnRenamed("segment", "id2")
    assert revenue_by(facts, by_id, "id").columns == ["id", "revenue"]


def test_audit_and_counts(spark):
    df = spark.createDataFrame([("b2", "2024-02-01"), ("b1", "2024-01-05"), ("b1", "2024-01-01")], "_batch_id string, _ingested_at string")
    assert [tuple(r) for r in batch_audit(df).collect()] == [("b1", 2, "2024-01-01", "2024-01-05"), ("b2", 1, "2024-02-01", "2024-02-01")]
    assert rows_of(rows_by(df, [])) == [(3,)]
    assert rows_of(rows_by(df, ["_batch_id"])) == [("b1", 2), ("b2", 1)]
