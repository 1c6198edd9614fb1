"""What Catalyst must choose for the operators to hold at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tierworks.operators.aggregates import revenue_by
from tierworks.operators.landing import full_refresh
from tierworks.operators.scd2 import join_as_of, scd2_apply
from tierworks.operators.windows import group_max_and_delta, newest_per_key, top_per_group
from tierworks.plans import plan_has, plan_text, scratch_path, sizing

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    names = ("orders", "events", "customer", "supplier")
    return {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in names}


@pytest.fixture(scope="module")
def dim(spark):
    return registered.stored_dimension(spark, SF_DIR)


def shuffles(df):
    return plan_text(df, "simple").count("Exchange hashpartitioning")


def test_rank_filters_cut_rows_before_the_shuffle(tables):
    newest = newest_per_key(tables["events"], ["user_id"], ["ts"])
    assert plan_text(newest, "simple").count("WindowGroupLimit") == 2
    top = top_per_group(tables["orders"], ["o_orderstatus"], "o_totalprice", 2)
    assert plan_text(top, "simple").count("WindowGroupLimit") == 2


def test_small_dimension_is_broadcast_and_the_fact_not_shuffled(spark, dim):
    invoices = registered.invoices(spark, SF_DIR)
    plan = revenue_by(invoices, dim, "segment")
    assert plan_has(plan, "BroadcastHashJoin")["BroadcastHashJoin"]
    assert shuffles(plan) == 1  # the final sum per segment
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan_text(plan)


def test_large_dimension_meets_sums_per_key(spark, dim, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    text = plan_text(revenue_by(registered.invoices(spark, SF_DIR), dim, "segment"), "simple")
    below_join = text[text.index("Join"):]
    assert "partial_sum" in below_join


def test_as_of_join_is_a_hash_join(spark, dim):
    joined = join_as_of(registered.invoices(spark, SF_DIR), dim, "customer_id", "id", "invoiced_at")
    found = plan_has(joined, "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")
    assert found == {"BroadcastHashJoin": True, "BroadcastNestedLoopJoin": False, "CartesianProduct": False}


def test_small_batch_leaves_the_dimension_where_it_is(spark, dim):
    batch = registered.customers(spark, SF_DIR)
    applied = scd2_apply(dim, batch, ["id"], ["segment", "region"], registered.at("2002-01-01 00:00:00"))
    text = plan_text(applied, "simple")
    assert "FullOuter" not in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_partition_and_filter_pruning(spark, dim):
    path = scratch_path(spark, "dim")
    full_refresh(dim, path, ["region"])
    stored = spark.read.parquet(path).filter("region = 'EUROPE' AND id > 10").select("segment")
    text = plan_text(stored)
    assert "PartitionFilters: [isnotnull(region" in text and "GreaterThan(id,10)" in text


def test_large_groups_are_not_shuffled_for_their_maximum(tables):
    calm_only = group_max_and_delta(tables["supplier"], ["s_nationkey"], "s_acctbal")
    assert shuffles(calm_only) == 1
    both = group_max_and_delta(tables["events"], ["event_type"], "value", rows_per_task=500)
    busy = plan_text(both, "simple").split("Union")[1]
    assert "BroadcastHashJoin" in busy


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_query_compares_all_pairs(spark, name):
    text = plan_text(registered.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
