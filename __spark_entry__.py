"""Registered queries over the given tables, and the SQL that must give the same rows.

``queries()`` runs the library's operators on a folder of Parquet tables; ``oracle_sql()`` states the
expected result of each in plain SQL. Customers, orders, suppliers and events stand in for the CRM,
billing, HR and web-event sources (see FIXTURES.md).
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierworks.functions import MONEY
from tierworks.operators.aggregates import batch_audit, revenue_by, rows_by, with_rank_and_share
from tierworks.operators.benchmark import benchmark_summary, medians_by
from tierworks.operators.cdc import ChangedTable, fold_changes
from tierworks.operators.conform import conform, stringify
from tierworks.operators.contract import CONTRACT, contract_check, contract_projection, with_contract
from tierworks.operators.dimension import StoredDimension
from tierworks.operators.landing import full_refresh, land_batch, land_bronze, publish, read_version, versions
from tierworks.operators.maintenance import compact, compact_small_files, repartition_table, retain
from tierworks.operators.scd2 import (
    first_versions,
    join_as_of,
    scd2_apply,
    scd2_as_of,
    scd2_current,
    scd2_rebuild,
    scd2_snapshot,
)
from tierworks.operators.storage import (
    batch_history,
    file_inventory,
    orphan_files,
)
from tierworks.operators.windows import (
    group_max_and_delta,
    newest_per_key,
    period_change,
    running_total,
    top_per_group,
)
from tierworks.plans.workspace import scratch_path, settle
from tierworks.sources.catalog import ensure_namespace, list_tables, read_table, resolve
from tierworks.sources.runs import read_runs, run_files
from tierworks.sources.schemas import read_json_kept
from tierworks.streaming.events import parse_events, stream_append, stream_by_batch, stream_dedupe, stream_first_copies, stream_source

KEY, TRACKED = ["id"], ["segment", "region"]
BATCH_1, BATCH_2, BATCH_3 = "1995-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- the given tables in the shapes the operators know -------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
        )
    )


def second_batch(first: DataFrame) -> DataFrame:
    """The customers as of a later date: moved, migrated, renamed, missing and new ones."""
    group = F.col("id") % 10
    changed = first.filter(group != 2).select(
        "id",
        F.when(group == 1, F.concat("name", F.lit("_x"))).otherwise(F.col("name")).alias("name"),
        F.when(group == 0, F.lit("MIGRATED")).otherwise(F.col("segment")).alias("segment"),
        F.when(group == 3, F.lit("MOVED")).otherwise(F.col("region")).alias("region"),
    )
    new = first.filter(F.col("id") % 50 == 0).withColumn("id", F.col("id") + 1_000_000)
    return changed.unionByName(new)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = customers(spark, sf_dir)
    start = first_versions(first, KEY, at(BATCH_1))
    return scd2_apply(start, second_batch(first), KEY, TRACKED, at(BATCH_2))


def stored_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as gold finds it: computed before and stored."""
    return settle(dimension(spark, sf_dir))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("invoiced_at"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("emp_id"),
        F.col("s_nationkey").alias("dept"),
        F.col("s_acctbal").alias("salary"),
    )


def stamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd"))
    arrived = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return with_contract(events, "web_events", day, arrived)


# --- gold ----------------------------------------------------------------------------------------


def revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = revenue_by(invoices(spark, sf_dir), stored_dimension(spark, sf_dir), "segment")
    return with_rank_and_share(revenue, "revenue", sum_type=MONEY)


def revenue_by_region_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(invoices(spark, sf_dir), stored_dimension(spark, sf_dir), "region", current_only=False)


def revenue_by_region_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(
        invoices(spark, sf_dir),
        stored_dimension(spark, sf_dir),
        "region",
        current_only=False,
        where=F.col("region") == "EUROPE",
    )


def customers_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank and share over many rows: the path that never gathers the table in one task."""
    revenue = revenue_by(invoices(spark, sf_dir), stored_dimension(spark, sf_dir), "id")
    return with_rank_and_share(revenue, "revenue", one_task_rows=500, sum_type=MONEY)


# --- windows -------------------------------------------------------------------------------------


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return newest_per_key(events, ["user_id"], ["ts", "event_id"], order_is_unique=True)


def top_earner_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_group(employees(spark, sf_dir), ["dept"], "salary").drop("rnk")


def top_values_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest order dates per status, with all orders of those days."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    return top_per_group(orders, ["o_orderstatus"], "o_orderdate", k=3)


def top_values_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    return top_per_group(orders, ["o_orderstatus"], "o_orderdate", k=3, rows_per_task=1_500)


def salary_against_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = group_max_and_delta(
        employees(spark, sf_dir),
        ["dept"],
        "salary",
        max_name="dept_max_salary",
        delta_name="delta_from_dept_avg",
        sum_type=MONEY,
    )
    return result.withColumn("delta_from_dept_avg", F.round("delta_from_dept_avg", 6))


def event_value_against_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = group_max_and_delta(
        _events_in_time(spark, sf_dir), ["event_type"], "value", rows_per_task=1_500, sum_type=MONEY
    )
    return result.withColumn("delta_from_avg", F.round("delta_from_avg", 6))


def invoice_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = invoices(spark, sf_dir).drop("invoiced_at")
    return running_total(bills, ["customer_id"], ["invoice_id"], "amount", sum_type=MONEY)


def invoice_period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = invoices(spark, sf_dir).drop("invoiced_at")
    changed = period_change(bills, ["customer_id"], ["invoice_id"], "amount", name="mom_change")
    return changed.withColumn("mom_change", F.round("mom_change", 4))


def _events_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")


def running_total_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of event types share all rows, so each group is cut into cells."""
    return running_total(
        _events_in_time(spark, sf_dir), ["event_type"], ["ts", "event_id"], "value", rows_per_task=1_500, sum_type=MONEY
    )


def running_total_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values far below a cent, added as they are; the result is rounded, not the values."""
    small = _events_in_time(spark, sf_dir).withColumn("value", F.col("value") / 1000)
    total = running_total(small, ["event_type"], ["ts", "event_id"], "value", rows_per_task=1_500)
    return total.select("event_type", "event_id", F.round("running_total", 6).alias("running_total"))


def period_change_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = period_change(
        _events_in_time(spark, sf_dir), ["event_type"], ["ts", "event_id"], "value", rows_per_task=1_500
    )
    return changed.withColumn("period_change", F.round("period_change", 4))


# --- silver --------------------------------------------------------------------------------------

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
}
EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "value": "double"}


def conform_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(stringify(table(spark, sf_dir, "orders")), ORDER_TYPES)[0]


def _untidy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 7 == 3, "n/a").otherwise(key.cast("string")).alias("invoice_id"),
        F.when(key % 11 != 5, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(key % 13 == 6, F.col("o_orderpriority"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("amount"),
        F.col("o_orderkey").alias("line"),
    )


def _conformed_untidy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    types = {"invoice_id": "bigint", "customer_id": "bigint", "amount": "double"}
    return conform(_untidy_orders(spark, sf_dir), types, required=["customer_id"])


def conform_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed_untidy(spark, sf_dir)[0]


def conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _conformed_untidy(spark, sf_dir)[1]
    return rejected.select("line", F.col("_reject_reason").alias("reason"))


def scd2_snapshot_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = customers(spark, sf_dir)
    start = scd2_snapshot(None, first, KEY, TRACKED, at(BATCH_1))
    return scd2_snapshot(start, second_batch(first), KEY, TRACKED, at(BATCH_2))


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = customers(spark, sf_dir)
    second = second_batch(first)
    batches = [(first, BATCH_1), (second, BATCH_2), (second, BATCH_3)]
    stamped = [df.withColumn("batch_ts", at(ts)) for df, ts in batches]
    return stamped[0].unionByName(stamped[1]).unionByName(stamped[2])


def scd2_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_rebuild(customer_log(spark, sf_dir), KEY, TRACKED, "batch_ts")


def priority_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with very many versions of few keys: the last status per priority and day."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", "o_orderdate")
        .agg(F.max("o_orderstatus").alias("status"))
    )
    return scd2_rebuild(daily, ["o_orderpriority"], ["status"], "o_orderdate", rows_per_task=500)


def third_batch(first: DataFrame) -> DataFrame:
    """A small one: some customers move once more, one of the vanished ones is back, and an old change is undone."""
    some = first.filter((F.col("id") % 10 == 3) | (F.col("id") % 10 == 2) | (F.col("id") % 100 == 0))
    return some.withColumn("segment", F.when(F.col("id") % 10 == 3, F.lit("THIRD")).otherwise(F.col("segment")))


def dimension_after_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as it is stored: only buckets with changes are rewritten, closed versions are added."""
    stored = StoredDimension(spark, scratch_path(spark, "dimension"), KEY, TRACKED, buckets=16)
    first = customers(spark, sf_dir)
    for batch, as_of in ((first, BATCH_1), (second_batch(first), BATCH_2), (third_batch(first), BATCH_3)):
        stored.apply(batch, at(as_of), batch_id=as_of)
    return stored.read().select("id", "name", "segment", "region", "effective_from", "effective_to", "is_current")


def order_changes(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Orders as changes of their ``key``: inserts, deletes and updates that leave columns out; some come twice."""
    orders, nr = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    changes = orders.select(
        key,
        F.when(nr % 10 == 0, "delete").when(nr % 10 <= 2, "insert").otherwise("update").alias("op"),
        F.col("o_orderdate").alias("ts"),
        nr.alias("nr"),
        F.when(nr % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.when(nr % 4 == 1, F.col("o_orderpriority")).alias("priority"),
    )
    return changes.unionByName(changes.filter(nr % 7 == 0))


def cdc_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_changes(order_changes(spark, sf_dir, "o_custkey"), ["o_custkey"], ["ts", "nr"], "op")


def cdc_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches that overlap in time, so later ones bring changes that are older than what is stored."""
    changes = order_changes(spark, sf_dir, "o_custkey")
    stored = ChangedTable(spark, scratch_path(spark, "changed"), ["o_custkey"], ["ts", "nr"], "op", buckets=16)
    for part in (2, 0, 1):
        stored.apply(changes.filter(F.col("nr") % 3 == part))
    return stored.read()


def cdc_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of keys that have all changes."""
    return fold_changes(order_changes(spark, sf_dir, "o_orderstatus"), ["o_orderstatus"], ["ts", "nr"], "op")


def invoices_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = stored_dimension(spark, sf_dir)
    joined = join_as_of(invoices(spark, sf_dir), dim, "customer_id", "id", "invoiced_at")
    return joined.select("invoice_id", "customer_id", "amount", "name", "segment", "region")


def orders_as_of_many_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.timestamp_add("HOUR", F.lit(5), "o_orderdate").alias("asked_at")
    )
    history = settle(priority_history(spark, sf_dir))
    joined = join_as_of(
        orders, history, "o_orderpriority", "o_orderpriority", "asked_at",
        broadcast=False, rows_per_task=5_000,
    )
    return joined.select("o_orderkey", "o_orderpriority", "asked_at", "status", "effective_from")


# --- bronze --------------------------------------------------------------------------------------


def monthly_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    return batch_audit(with_contract(orders, "orders", month, F.col("o_orderdate")))


def contract_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stamped_events(spark, sf_dir)
    return contract_check({"web_events": events, "raw_events": events.drop("_batch_id")})


def _landed(spark: SparkSession, raw: str, name: str, **options) -> DataFrame:
    bronze = scratch_path(spark, "bronze")
    land_bronze(spark, raw, bronze, **options)
    return read_table(spark, f"{bronze}/{name}").drop(*CONTRACT)


def land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as two CSV batches whose headers differ in order, landed and typed again."""
    raw = scratch_path(spark, "raw")
    orders = stringify(table(spark, sf_dir, "orders"))
    even = F.col("o_orderkey").cast("bigint") % 2 == 0
    land_batch(orders.filter(even), "orders", f"{raw}/orders")
    land_batch(orders.filter(~even).select(*reversed(orders.columns)), "orders", f"{raw}/orders")
    return conform(_landed(spark, raw, "orders"), ORDER_TYPES)[0]


def _raw_json(spark: SparkSession, sf_dir: str) -> str:
    raw = scratch_path(spark, "raw")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    land_batch(events, "web_events", f"{raw}/web_events", fmt="json")
    return raw


def landed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landing itself reports: the rows of each source."""
    return land_bronze(spark, _raw_json(spark, sf_dir), scratch_path(spark, "bronze"))


def partitioned_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "partitioned")
    full_refresh(table(spark, sf_dir, "orders"), out, ["o_orderstatus"])
    return spark.read.parquet(out).select(*table(spark, sf_dir, "orders").columns)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables landed by name: the namespace lists them, and they are read by their names."""
    space = f"lake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {space} LOCATION '{scratch_path(spark, space)}'")
    ensure_namespace(spark, space)
    for name in ("customer", "orders"):
        full_refresh(table(spark, sf_dir, name), f"{space}.{name}")
    counts = [df.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("n")) for n, df in resolve(spark, {n: f"{space}.{n}" for n in ("customer", "orders")}).items()]
    return settle(list_tables(spark, space).select("table").join(counts[0].unionByName(counts[1]), "table"))


def first_version_of_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as it was before its second batch was published."""
    root = scratch_path(spark, "published")
    first = first_versions(customers(spark, sf_dir), KEY, at(BATCH_1))
    publish(first, root, ["region"])
    publish(scd2_apply(read_version(spark, root, 1), second_batch(customers(spark, sf_dir)), KEY, TRACKED, at(BATCH_2)), root, ["region"])
    assert len(versions(spark, root)) == 2
    return read_version(spark, root, 1).select("id", "name", "segment", "region", "is_current")


def land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, _raw_json(spark, sf_dir), "web_events")
    return conform(landed, {"ts": "timestamp_ntz"})[0]


def land_json_late_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose schema is kept from a first batch; later ones have one more field and, now and then, another type."""
    folder, schema = scratch_path(spark, "kept"), f"{scratch_path(spark, 'schemas')}.json"
    events = table(spark, sf_dir, "events")
    event, odd = F.col("event_id"), F.col("event_id") % 7 == 0
    land_batch(events.filter(event % 2 == 0).select("event_id", "user_id"), "events", folder, "first", fmt="json")
    read_json_kept(spark, folder, schema)
    user = F.when(~odd, F.col("user_id"))
    later = events.filter(event % 2 == 1)
    land_batch(later.filter(~odd).select("event_id", user.alias("user_id"), "value"), "events", folder, "second", fmt="json")
    land_batch(later.filter(odd).select("event_id", F.lit("unknown").alias("user_id"), "value"), "events", folder, "third", fmt="json")
    rescued = F.col("_rescued")
    return read_json_kept(spark, folder, schema).select(
        "event_id",
        "user_id",
        F.get_json_object(rescued, "$.value").cast("double").alias("value"),
        F.get_json_object(rescued, "$.user_id").alias("odd_user"),
    )


def land_json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, _raw_json(spark, sf_dir), "web_events", as_strings=True)
    return conform(landed, EVENT_TYPES)[0]


# --- streams -------------------------------------------------------------------------------------


def props_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(table(spark, sf_dir, "events"), "k BIGINT", "props")[0]


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events with a payload that is no JSON; they must come back whole, the others not."""
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id"))
    events = table(spark, sf_dir, "events").withColumn("props", F.coalesce(broken, "props"))
    return parse_events(events, "k BIGINT", "props")[1].select("event_id", "props")


def _order_stream(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """The events as JSON lines in a folder, read as a stream."""
    folder = scratch_path(spark, "stream-in")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("string").alias("ts"),
    )
    lines = events.select(F.to_json(F.struct("*")).alias("value"))
    for _ in range(copies):
        lines.write.mode("append").text(folder)
    return stream_source(spark, "files", path=folder)


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = scratch_path(spark, "stream-out")
    query = stream_append(stream, out, scratch_path(spark, "stream-log"), available_now=True)
    query.awaitTermination()
    return spark.read.parquet(out)


def stream_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, parse_events(_order_stream(spark, sf_dir, copies=1))[0])


def stream_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_events(_order_stream(spark, sf_dir, copies=2))
    once = stream_dedupe(good, ["event_id"], "ts", "60 days")
    return _drained(spark, once.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def stream_first_and_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two runs of one query. The second brings repeats, events on time, and events behind the watermark."""
    folder, out, log = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "log"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("customer_id"), F.col("value").alias("amount"), F.col("ts").cast("string").alias("ts"))
    nth = F.col("event_id") % 10
    second = events.filter(nth >= 8).unionByName(events.filter((nth < 8) & (F.col("event_id") % 5 == 0)))
    for part in (events.filter(nth < 8), second):
        part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(folder)
        good, _ = parse_events(stream_source(spark, "files", path=folder))
        first = stream_first_copies(good, ["event_id"], "ts", "5 days", remember="400 days")
        stamped = first.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        stream_append(stamped, out, log, available_now=True, partition_by=["_late"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "customer_id", "amount", "ts", F.col("_late").cast("boolean").alias("_late"))


def stream_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches as folders of their own; the same ones again, as after a lost commit, add nothing."""
    events = parse_events(_order_stream(spark, sf_dir, copies=1))[0]
    out = scratch_path(spark, "stream-batches")
    for _ in range(2):
        stream_by_batch(events, out, scratch_path(spark, "stream-log"), available_now=True).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# --- stored files --------------------------------------------------------------------------------


def _retention(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return retain(table(spark, sf_dir, "events"), "ts", at("2024-01-31 00:00:00"), 10)


def compacted_with_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files have a column that earlier ones lack; the compacted table has it too."""
    src, dst = scratch_path(spark, "grown"), scratch_path(spark, "compacted")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    orders.filter("o_orderstatus <> 'O'").drop("o_orderpriority").write.parquet(src)
    orders.filter("o_orderstatus = 'O'").write.mode("append").parquet(src)
    return compact(spark, src, dst)


def compacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    table(spark, sf_dir, "orders").repartition(20).write.parquet(many)
    return compact(spark, many, few)


def compacted_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files beside two larger ones, in folders by priority: only the small ones are written anew."""
    path = scratch_path(spark, "appended")
    orders = table(spark, sf_dir, "orders")
    rare = F.col("o_orderstatus") == "P"
    orders.filter(~rare).repartition(2).write.partitionBy("o_orderpriority").parquet(path)
    orders.filter(rare).repartition(8).write.mode("append").partitionBy("o_orderpriority").parquet(path)
    compact_small_files(spark, path, small_bytes=16 * 1024, target_bytes=1024 * 1024)
    return spark.read.parquet(path).select(*orders.columns)


def repartitioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = scratch_path(spark, "by-status"), scratch_path(spark, "by-priority")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(before)
    return repartition_table(spark, before, after, ["o_orderpriority"])


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = None
    for name in ("customer", "events", "lineitem", "orders", "supplier"):
        one = file_inventory(spark, f"{sf_dir}/{name}.parquet")
        found = one if found is None else found.unionByName(one)
    return found.select(
        F.substring_index("file_path", "/", -1).alias("file"), "records", (F.col("file_bytes") > 0).alias("has_bytes"), "is_small"
    )


def history_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored as one batch per year."""
    out = scratch_path(spark, "batches")
    orders = table(spark, sf_dir, "orders").withColumn("_batch_id", F.date_format("o_orderdate", "'y'yyyy"))
    orders.write.partitionBy("_batch_id").parquet(out)
    # How many files a batch has is the writer's choice.
    return batch_history(spark, out, "_batch_id").drop("files", "first_written", "last_written")


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch write into a stream's folder leaves files the stream never committed; what they hold."""
    out = scratch_path(spark, "stream-out")
    stream = parse_events(_order_stream(spark, sf_dir, copies=1))[0]
    stream_append(stream, out, scratch_path(spark, "stream-log"), available_now=True).awaitTermination()
    table(spark, sf_dir, "orders").write.mode("append").parquet(out)
    tomorrow = F.current_timestamp() + F.make_dt_interval(F.lit(1))
    found = orphan_files(spark, out, 0, tomorrow).select(F.col("_metadata.file_path").alias("file"))
    orders = table(spark, sf_dir, "orders")
    stored = spark.read.schema(orders.schema).parquet(f"{out}/[!_.]*")
    named = stored.withColumn("file", F.col("_metadata.file_path"))
    return named.join(F.broadcast(settle(found)), "file", "left_semi").select(*orders.columns)


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the orphan files hold."""
    return orphans(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def runs_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a benchmark run: status as implementation, order key as file name."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("impl"),
        F.format_string("run-%012d.json", "o_orderkey").alias("file_name"),
        F.struct(
            price.alias("wall_ms_excl_startup"),
            (price + 1000).alias("wall_ms_incl_startup"),
            F.col("o_custkey").alias("rows"),
        ).alias("totals"),
        F.when(
            F.col("o_orderkey") % 3 != 0,
            F.struct(
                (price / 8).alias("peak_rss_mb"),
                (price / 2).alias("user_cpu_ms"),
                (price / 4).alias("sys_cpu_ms"),
            ),
        ).alias("resources"),
    )


def run_medians_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of a few groups that share all rows."""
    orders = table(spark, sf_dir, "orders")
    return medians_by(orders, ["o_orderstatus"], ["o_totalprice", "o_custkey"], rows_per_task=1_500)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = benchmark_summary(runs_from_orders(spark, sf_dir))
    doubles = ["wall_ms", "work_ms", "rows_per_sec", "cpu_ms", "cpu_per_wall", "rss_mb"]
    return summary.withColumns({c: F.round(c, 5) for c in doubles})


def _stored_runs(spark: SparkSession, sf_dir: str) -> str:
    """A folder of run records, one a file: the orders of a priority and year are a run, those of 1995 with totals of another type."""
    out = scratch_path(spark, "runs")
    run = table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("o_totalprice").alias("ms")
    )
    named = run.select(
        F.col("o_orderpriority").alias("impl"),
        F.concat_ws("-", "o_orderpriority", "year").alias("run_id"),
        F.struct("rows", F.col("ms").alias("wall_ms_excl_startup"), (F.col("ms") + 1).alias("wall_ms_incl_startup")).alias("totals"),
        "year",
    )
    one_each = {"maxRecordsPerFile": 1}
    named.filter("year <> 1995").drop("year").write.options(**one_each).json(out)
    torn = named.filter("year = 1995").withColumn("totals", F.lit("lost"))
    torn.drop("year").write.mode("append").options(**one_each).json(out)
    return out


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of run records read from files; the unreadable ones do not count."""
    runs = read_runs(spark, _stored_runs(spark, sf_dir)).withColumn("file_name", F.col("run_id"))
    return benchmark_summary(runs).select("impl", "wall_ms", "work_ms", "rows", "kept_runs", "total_runs")


def run_file_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder of run records by what is wrong with them."""
    found = run_files(spark, _stored_runs(spark, sf_dir))
    return found.groupBy(F.coalesce("reason", F.lit("readable")).alias("reason")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("records").alias("records")
    )


# --- driver contract -----------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return revenue_by_segment(spark, "/root/testdata/sf0.001")


def text_queries():
    """The module of the text operators' queries; None where that package is not installed."""
    found = importlib.util.find_spec("tierworks.llm")
    if found is None or found.origin is None:  # an empty folder has no origin
        return None
    from tierworks.llm import queries as text

    return text


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    text = text_queries()
    return table_queries() | (text.queries() if text else {})


def oracle_sql() -> dict[str, str]:
    text = text_queries()
    return table_sql() | (text.oracle_sql() if text else {})


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "revenue_by_segment": revenue_by_segment,
        "revenue_by_region_all_versions": revenue_by_region_all_versions,
        "revenue_by_region_filtered": revenue_by_region_filtered,
        "customers_ranked": customers_ranked,
        "newest_per_key": latest_event_per_user,
        "top_earner_per_group": top_earner_per_group,
        "top_values_per_group": top_values_per_group,
        "top_values_hot_groups": top_values_hot_groups,
        "group_max_and_delta": salary_against_group,
        "group_max_hot_groups": event_value_against_type,
        "running_total": invoice_running_total,
        "running_total_hot_groups": running_total_hot_groups,
        "running_total_of_parts": running_total_of_parts,
        "period_change": invoice_period_change,
        "period_change_hot_groups": period_change_hot_groups,
        "conform_typed": conform_typed,
        "conform_accepted": conform_accepted,
        "conform_rejects": conform_rejects,
        "scd2_apply": dimension,
        "scd2_snapshot": scd2_snapshot_two_batches,
        "scd2_rebuild": scd2_rebuilt,
        "scd2_rebuild_hot_keys": priority_history,
        "dimension_after_three_batches": dimension_after_three_batches,
        "cdc_applied": cdc_applied,
        "cdc_in_batches": cdc_in_batches,
        "cdc_hot_keys": cdc_hot_keys,
        "scd2_current": lambda s, d: scd2_current(dimension(s, d)),
        "scd2_as_of": lambda s, d: scd2_as_of(dimension(s, d), at("1997-06-01 00:00:00")),
        "join_as_of": invoices_as_of,
        "join_as_of_many_versions": orders_as_of_many_versions,
        "batch_audit": monthly_batches,
        "rows_by_region": lambda s, d: rows_by(dimension(s, d), ["region"]),
        "contract_projection": lambda s, d: contract_projection(stamped_events(s, d), 3),
        "contract_check": contract_of_tables,
        "land_csv": land_csv,
        "landed_sources": landed_sources,
        "partitioned_refresh": partitioned_refresh,
        "catalog_tables": catalog_tables,
        "first_version_of_dimension": first_version_of_dimension,
        "land_json": land_json,
        "land_json_strings": land_json_strings,
        "land_json_late_field": land_json_late_field,
        "parse_events": props_parsed,
        "dead_letters": dead_letters,
        "stream_append": stream_appended,
        "stream_dedupe": stream_deduped,
        "stream_first_and_late": stream_first_and_late,
        "stream_in_batches": stream_in_batches,
        "retention_kept": lambda s, d: _retention(s, d)[0],
        "retention_archived": lambda s, d: _retention(s, d)[1],
        "compacted_rows": compacted_rows,
        "compacted_with_added_column": compacted_with_added_column,
        "compacted_small_files": compacted_small_files,
        "repartitioned_rows": repartitioned_rows,
        "file_inventory": stored_records,
        "batch_history": history_of_batches,
        "orphan_files": orphans,
        "orphan_rows": orphan_rows,
        "benchmark_summary": run_summary,
        "run_records": run_records,
        "run_file_reasons": run_file_reasons,
        "medians_hot_groups": run_medians_hot_groups,
    }


_CUSTOMERS = """
cust AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, r_name AS region
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
batch2 AS (
  SELECT id,
         CASE WHEN id % 10 = 1 THEN name || '_x' ELSE name END AS name,
         CASE WHEN id % 10 = 0 THEN 'MIGRATED' ELSE segment END AS segment,
         CASE WHEN id % 10 = 3 THEN 'MOVED' ELSE region END AS region
  FROM cust WHERE id % 10 <> 2
  UNION ALL
  SELECT id + 1000000, name, segment, region FROM cust WHERE id % 50 = 0
)"""

_DIM = f"""{_CUSTOMERS},
dim AS (
  SELECT c.id, c.name, c.segment, c.region,
         TIMESTAMP '{BATCH_1}' AS effective_from,
         CASE WHEN b.id IS NOT NULL THEN TIMESTAMP '{BATCH_2}' END AS effective_to,
         b.id IS NULL AS is_current
  FROM cust c
  LEFT JOIN batch2 b ON b.id = c.id
    AND (b.segment IS DISTINCT FROM c.segment OR b.region IS DISTINCT FROM c.region)
  UNION ALL
  SELECT b.id, b.name, b.segment, b.region, TIMESTAMP '{BATCH_2}', NULL, true
  FROM batch2 b
  LEFT JOIN cust c ON c.id = b.id
  WHERE c.id IS NULL
     OR b.segment IS DISTINCT FROM c.segment OR b.region IS DISTINCT FROM c.region
)"""

_DIM_3 = f"""{_DIM},
batch3 AS (
  SELECT id, name, CASE WHEN id % 10 = 3 THEN 'THIRD' ELSE segment END AS segment, region
  FROM cust WHERE id % 10 IN (2, 3) OR id % 100 = 0
),
changed AS (
  SELECT b.*, d.id IS NOT NULL AS known FROM batch3 b LEFT JOIN dim d ON d.id = b.id AND d.is_current
  WHERE d.id IS NULL OR b.segment IS DISTINCT FROM d.segment OR b.region IS DISTINCT FROM d.region
),
dim3 AS (
  SELECT d.id, d.name, d.segment, d.region, d.effective_from,
         CASE WHEN c.id IS NOT NULL THEN TIMESTAMP '{BATCH_3}' ELSE d.effective_to END AS effective_to,
         d.is_current AND c.id IS NULL AS is_current
  FROM dim d LEFT JOIN changed c ON c.id = d.id AND d.is_current
  UNION ALL
  SELECT id, name, segment, region, TIMESTAMP '{BATCH_3}', NULL, true FROM changed
)"""

_FOLDED = """
WITH changes AS (
  SELECT {key} AS k, o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'delete' WHEN o_orderkey % 10 <= 2 THEN 'insert' ELSE 'update' END AS op,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 4 = 1 THEN o_orderpriority END AS priority,
         row_number() OVER (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey) AS nth
  FROM orders
),
resets AS (SELECT k, max(nth) AS nth, arg_max(op, nth) AS op FROM changes WHERE op <> 'update' GROUP BY k)
SELECT c.k AS {key}, arg_max(price, c.nth) FILTER (WHERE price IS NOT NULL) AS price,
       arg_max(priority, c.nth) FILTER (WHERE priority IS NOT NULL) AS priority
FROM changes c LEFT JOIN resets r USING (k)
WHERE r.nth IS NULL OR (r.op = 'insert' AND c.nth >= r.nth) GROUP BY c.k"""

_STREAMED = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, value AS amount,
       rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS ts
FROM events"""

_MONEY = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

_RANKED = """
SELECT {by}, revenue,
       CAST(rank() OVER (ORDER BY revenue DESC) AS BIGINT) AS revenue_rank,
       round(revenue / CAST(sum(CAST(revenue AS DECIMAL(18,2))) OVER () AS DOUBLE), 9) AS revenue_share
FROM rev"""

_TOP_VALUES = """
SELECT * FROM (
  SELECT o_orderstatus, o_orderdate, o_orderkey,
         CAST(dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS BIGINT) AS rnk
  FROM orders)
WHERE rnk <= 3"""

_UNTIDY = """
raw AS (
  SELECT CASE WHEN o_orderkey % 7 = 3 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS invoice_id,
         CASE WHEN o_orderkey % 11 <> 5 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 13 = 6 THEN o_orderpriority
              ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
         o_orderkey AS line
  FROM orders
)"""

_HISTORY = """
daily AS (
  SELECT o_orderpriority, o_orderdate, max(o_orderstatus) AS status
  FROM orders GROUP BY o_orderpriority, o_orderdate
),
marked AS (
  SELECT *, lag(status) OVER w AS before, row_number() OVER w AS nth
  FROM daily WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate)
),
history AS (
  SELECT o_orderpriority, o_orderdate AS effective_from, status,
         lead(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS effective_to
  FROM marked WHERE nth = 1 OR status IS DISTINCT FROM before
)"""

_RUNS = """
SELECT * FROM (SELECT o_orderpriority AS impl, o_orderpriority || '-' || year(o_orderdate) AS run_id, year(o_orderdate) AS year,
       count(*) AS rows, max(o_totalprice) AS ms FROM orders GROUP BY 1, 2, 3)"""

_INVENTORY = " UNION ALL ".join(
    f"SELECT '{name}.parquet' AS file, count(*) AS records, true AS has_bytes, true AS is_small FROM {name}"
    for name in ("customer", "events", "lineitem", "orders", "supplier")
)

def table_sql() -> dict[str, str]:
    return {
        "revenue_by_segment": f"""WITH {_DIM},
rev AS (
  SELECT segment, {_MONEY} AS revenue
  FROM orders JOIN dim ON o_custkey = id
  WHERE effective_to IS NULL GROUP BY segment
) {_RANKED.format(by="segment")}""",
        "revenue_by_region_all_versions": f"""WITH {_DIM}
SELECT region, {_MONEY} AS revenue FROM orders JOIN dim ON o_custkey = id GROUP BY region""",
        "revenue_by_region_filtered": f"""WITH {_DIM}
SELECT region, {_MONEY} AS revenue
FROM orders JOIN dim ON o_custkey = id WHERE region = 'EUROPE' GROUP BY region""",
        "customers_ranked": f"""WITH {_DIM},
rev AS (
  SELECT id, {_MONEY} AS revenue
  FROM orders JOIN dim ON o_custkey = id
  WHERE effective_to IS NULL GROUP BY id
) {_RANKED.format(by="id")}""",
        "newest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
        "top_earner_per_group": """
SELECT emp_id, dept, salary
FROM (SELECT s_suppkey AS emp_id, s_nationkey AS dept, s_acctbal AS salary,
             dense_rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS rnk
      FROM supplier)
WHERE rnk = 1""",
        "top_values_per_group": _TOP_VALUES,
        "top_values_hot_groups": _TOP_VALUES,
        "group_max_hot_groups": """
SELECT event_type, ts, event_id, value, max(value) OVER w AS group_max,
       round(value - CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE)
                     / count(value) OVER w, 6) AS delta_from_avg
FROM events WINDOW w AS (PARTITION BY event_type)""",
        "group_max_and_delta": """
SELECT s_suppkey AS emp_id, s_nationkey AS dept, s_acctbal AS salary,
       max(s_acctbal) OVER w AS dept_max_salary,
       round(s_acctbal - CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) OVER w AS DOUBLE)
                         / count(s_acctbal) OVER w, 6) AS delta_from_dept_avg
FROM supplier WINDOW w AS (PARTITION BY s_nationkey)""",
        "running_total": """
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_totalprice AS amount,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
         PARTITION BY o_custkey ORDER BY o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM orders""",
        "running_total_of_parts": """
SELECT event_type, event_id, round(sum(value / 1000) OVER (
         PARTITION BY event_type ORDER BY ts NULLS LAST, event_id ROWS UNBOUNDED PRECEDING), 6) AS running_total
FROM events""",
        "running_total_hot_groups": """
SELECT event_type, ts, event_id, value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (
         PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM events""",
        "period_change": """
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_totalprice AS amount,
       round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 4)
         AS mom_change
FROM orders""",
        "period_change_hot_groups": """
SELECT event_type, ts, event_id, value,
       round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 4) AS period_change
FROM events""",
        "conform_typed": _ORDERS,
        "conform_accepted": f"""WITH {_UNTIDY}
SELECT CAST(invoice_id AS BIGINT) AS invoice_id, CAST(customer_id AS BIGINT) AS customer_id,
       CAST(amount AS DOUBLE) AS amount, line
FROM raw
WHERE TRY_CAST(invoice_id AS BIGINT) IS NOT NULL AND customer_id IS NOT NULL
  AND TRY_CAST(amount AS DOUBLE) IS NOT NULL""",
        "conform_rejects": f"""WITH {_UNTIDY},
why AS (
  SELECT line, concat_ws('; ',
    CASE WHEN TRY_CAST(invoice_id AS BIGINT) IS NULL THEN 'invoice_id: not bigint' END,
    CASE WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'amount: not double' END,
    CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END) AS reason
  FROM raw
)
SELECT line, reason FROM why WHERE reason <> ''""",
        "scd2_apply": f"""WITH {_DIM}
SELECT id, name, segment, region, effective_from, effective_to, is_current FROM dim""",
        "scd2_snapshot": f"""WITH {_DIM}
SELECT id, name, segment, region, effective_from AS dbt_valid_from, effective_to AS dbt_valid_to,
       md5('["' || CAST(id AS VARCHAR) || '","' || strftime(effective_from, '%Y-%m-%d %H:%M:%S.%f') || '"]') AS dbt_scd_id
FROM dim""",
        "scd2_rebuild": f"""WITH {_DIM}
SELECT id, name, segment, region, effective_from, effective_to, is_current FROM dim""",
        "scd2_rebuild_hot_keys": f"""WITH {_HISTORY}
SELECT o_orderpriority, effective_from, status, effective_to, effective_to IS NULL AS is_current
FROM history""",
        "dimension_after_three_batches": f"""WITH {_DIM_3}
SELECT id, name, segment, region, effective_from, effective_to, is_current FROM dim3""",
        "cdc_applied": _FOLDED.format(key="o_custkey"),
        "cdc_in_batches": _FOLDED.format(key="o_custkey"),
        "cdc_hot_keys": _FOLDED.format(key="o_orderstatus"),
        "scd2_current": f"""WITH {_DIM}
SELECT id, name, segment, region, effective_from, effective_to, is_current FROM dim WHERE is_current""",
        "scd2_as_of": f"""WITH {_DIM}
SELECT id, name, segment, region, effective_from, effective_to, is_current FROM dim
WHERE effective_from <= TIMESTAMP '1997-06-01' AND coalesce(effective_to > TIMESTAMP '1997-06-01', true)""",
        "join_as_of": f"""WITH {_DIM}
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_totalprice AS amount, name, segment, region
FROM orders JOIN dim ON o_custkey = id AND effective_from <= o_orderdate
 AND (effective_to IS NULL OR o_orderdate < effective_to)""",
        "join_as_of_many_versions": f"""WITH {_HISTORY},
asked AS (SELECT o_orderkey, o_orderpriority, o_orderdate + INTERVAL 5 HOUR AS asked_at FROM orders)
SELECT o_orderkey, o_orderpriority, asked_at, status, effective_from
FROM asked JOIN history USING (o_orderpriority)
WHERE effective_from <= asked_at AND (effective_to IS NULL OR asked_at < effective_to)""",
        "batch_audit": """
SELECT strftime(o_orderdate, '%Y-%m') AS _batch_id, count(*) AS rows,
       min(o_orderdate) AS earliest, max(o_orderdate) AS latest
FROM orders GROUP BY 1""",
        "rows_by_region": f"""WITH {_DIM}
SELECT region, count(*) AS count FROM dim GROUP BY region""",
        "contract_projection": """
SELECT 'web_events' AS _source,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS _batch_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS _ingested_at
FROM events ORDER BY _batch_id NULLS LAST, _ingested_at LIMIT 3""",
        "contract_check": """
SELECT 'raw_events' AS source, '_batch_id' AS missing, count(*) FILTER (WHERE ts IS NULL) AS null_rows
FROM events
UNION ALL
SELECT 'web_events', '',
       count(*) FILTER (WHERE ts IS NULL OR event_type IS NULL OR event_type = 'error') FROM events""",
        "land_csv": _ORDERS,
        "landed_sources": "SELECT 'web_events' AS source, count(*) AS rows FROM events",
        "partitioned_refresh": _ORDERS,
        "catalog_tables": """
SELECT 'customer' AS "table", count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders""",
        "first_version_of_dimension": """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, r_name AS region, true AS is_current
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "land_json": _EVENTS,
        "land_json_strings": _EVENTS,
        "land_json_late_field": """
SELECT event_id, CASE WHEN event_id % 2 = 0 OR event_id % 7 <> 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 2 = 1 THEN value END AS value,
       CASE WHEN event_id % 2 = 1 AND event_id % 7 = 0 THEN 'unknown' END AS odd_user
FROM events""",
        "parse_events": "SELECT CAST(props->>'k' AS BIGINT) AS k FROM events",
        "dead_letters": """
SELECT event_id, '{broken ' || CAST(event_id AS VARCHAR) AS props FROM events WHERE event_type = 'error'""",
        "stream_append": _STREAMED,
        "stream_in_batches": _STREAMED,
        "stream_first_and_late": """
WITH ahead AS (SELECT epoch_ms(max(ts)) - 5 * 86400000 AS at FROM events WHERE event_id % 10 < 8)
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, value AS amount, ts,
       event_id % 10 >= 8 AND epoch_ms(ts) < ahead.at AS _late
FROM events, ahead""",
        "stream_dedupe": """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
       value AS amount, ts
FROM events""",
        "retention_kept": f"{_EVENTS} WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY",
        "retention_archived": f"{_EVENTS} WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 10 DAY",
        "compacted_rows": _ORDERS,
        "compacted_with_added_column": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "compacted_small_files": _ORDERS,
        "repartitioned_rows": _ORDERS,
        "file_inventory": _INVENTORY,
        "batch_history": """
SELECT strftime(o_orderdate, 'y%Y') AS _batch_id, count(*) AS rows FROM orders GROUP BY 1""",
        "orphan_files": "SELECT * FROM orders",
        "orphan_rows": "SELECT count(*) AS n FROM orders",
        "run_records": f"""
WITH runs AS ({_RUNS} WHERE year <> 1995),
first AS (SELECT impl, min(run_id) AS run_id, count(*) AS total FROM runs GROUP BY impl)
SELECT r.impl, median(ms + 1) AS wall_ms, median(ms) AS work_ms, arg_min(rows, r.run_id) AS rows,
       count(*) AS kept_runs, max(total) AS total_runs
FROM runs r JOIN first f ON r.impl = f.impl AND (total = 1 OR r.run_id <> f.run_id)
GROUP BY r.impl""",
        "run_file_reasons": f"""
SELECT CASE WHEN year = 1995 THEN 'malformed' ELSE 'readable' END AS reason, count(*) AS files,
       CAST(sum(CASE WHEN year = 1995 THEN 0 ELSE 1 END) AS BIGINT) AS records
FROM ({_RUNS}) GROUP BY 1""",
        "benchmark_summary": """
WITH runs AS (
  SELECT o_orderstatus AS impl, o_orderkey AS nth, o_custkey AS rows, o_totalprice AS work,
         o_totalprice + 1000 AS wall,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 8 ELSE 0 END AS rss,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 2 + o_totalprice / 4 ELSE 0 END AS cpu,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS total
  FROM orders
),
mid AS (
  SELECT impl, median(wall) AS wall_ms, median(work) AS work_ms, median(cpu) AS cpu_ms,
         median(rss) AS rss_mb, arg_min(rows, nth) AS rows, count(*) AS kept_runs,
         max(total) AS total_runs
  FROM runs WHERE total = 1 OR rn > 1 GROUP BY impl
)
SELECT impl, round(wall_ms, 5) AS wall_ms, round(work_ms, 5) AS work_ms,
       round(CASE WHEN work_ms > 0 THEN rows / (work_ms / 1000) ELSE 0 END, 5) AS rows_per_sec,
       round(cpu_ms, 5) AS cpu_ms,
       round(CASE WHEN wall_ms > 0 THEN cpu_ms / wall_ms ELSE 0 END, 5) AS cpu_per_wall,
       round(rss_mb, 5) AS rss_mb, rows, kept_runs, total_runs
FROM mid""",
        "medians_hot_groups": """
SELECT o_orderstatus, median(o_totalprice) AS o_totalprice, median(o_custkey) AS o_custkey
FROM orders GROUP BY o_orderstatus""",
    }
