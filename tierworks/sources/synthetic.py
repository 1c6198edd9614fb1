"""Seed data of any size: every value is a hash of (seed, source, column, row), so a lost task is
recomputed to the same rows and any number of executors gives the same table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierworks.operators.contract import with_contract

# The twelve source shapes, format and columns.
SHAPES = {
    "crm_customers": ("csv", ["id", "name", "segment", "region"]),
    "erp_products": ("csv", ["sku", "category", "unit_cost"]),
    "web_events": ("json", ["event_id", "customer_id", "url", "ts"]),
    "mobile_events": ("json", ["event_id", "customer_id", "screen", "ts"]),
    "billing_invoices": ("csv", ["invoice_id", "customer_id", "amount", "status"]),
    "support_tickets": ("json", ["ticket_id", "customer_id", "priority", "state"]),
    "hr_employees": ("csv", ["emp_id", "dept", "salary"]),
    "inventory_cdc": ("json", ["sku", "qty", "op", "ts"]),
    "marketing_api": ("json", ["campaign_id", "customer_id", "channel"]),
    "partner_feed": ("csv", ["partner_id", "customer_id", "referral"]),
    "iot_telemetry": ("json", ["device_id", "metric", "value", "ts"]),
    "finance_ledger": ("csv", ["txn_id", "account", "debit", "credit"]),
}
# The domains of the columns that are not a number from 1 to 100.
DOMAINS = {
    "segment": ["smb", "mid", "ent"],
    "region": ["na", "emea", "apac"],
    "dept": ["eng", "sales", "ops"],
    "salary": [90000, 110000, 130000, 150000, 175000],
}
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _draw(seed: int, source: str, column: str, below: int | Column) -> Column:
    """A repeatable number in ``0 .. below - 1`` for the row."""
    bound = below if isinstance(below, Column) else F.lit(below)
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(source), F.lit(column), F.col("_row")), bound)


def synth_source(
    spark: SparkSession,
    name: str,
    rows: int,
    days: int = 0,
    seed: int = 0,
    *,
    now: datetime | None = None,
    batch_id: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One seed batch of the named shape with its contract columns.

    ``id`` runs from 0 and is the same in every batch; ``customer_id`` always points at an existing
    ``id``. With ``days`` the rows are spread over that many days before ``now``, and a row's ``ts``
    equals its time of arrival.
    """
    _, columns = SHAPES[name]
    now = now or datetime.now(timezone.utc)
    moment = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    back = _draw(seed, name, "_back", days * 86_400_000_000) if days > 0 else F.lit(0)
    arrived = F.date_format(F.timestamp_add("MICROSECOND", -back, moment), ISO)

    def value(column: str) -> Column:
        if column == "id":
            return F.col("_row")
        if column == "name":
            return F.concat(F.lit("cust_"), F.col("_row"))
        if column == "customer_id":
            return _draw(seed, name, column, rows)
        if column == "ts":
            return F.col("_arrived")
        if column in DOMAINS:
            choices = F.array(*[F.lit(v) for v in DOMAINS[column]])
            nth = _draw(seed, name, column, len(DOMAINS[column])).cast("int")
            return F.element_at(choices, nth + 1)
        return _draw(seed, name, column, 100) + 1

    numbered = spark.range(0, rows, numPartitions=partitions).withColumnRenamed("id", "_row")
    filled = numbered.withColumn("_arrived", arrived)
    shaped = filled.select(*[value(c).alias(c) for c in columns], "_arrived")
    stamped = with_contract(shaped, name, batch_id or str(uuid.uuid4()), F.col("_arrived"))
    return stamped.drop("_arrived")


def synth_order_stream(spark: SparkSession, rows_per_second: int, seed: int = 0) -> DataFrame:
    """An endless stream of order events as JSON text in ``value``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    event = ticks.select(F.col("value").alias("_row"), "timestamp").select(
        F.struct(
            # One digest per row: a key that stays the same when the row is produced again.
            F.md5(F.concat_ws("-", F.lit(str(seed)), "_row")).alias("event_id"),
            (_draw(seed, "orders", "customer_id", 50) + 1).alias("customer_id"),
            ((_draw(seed, "orders", "amount", 49_501) + 500) / 100).alias("amount"),
            F.date_format(F.col("timestamp"), ISO).alias("ts"),
        ).alias("event")
    )
    return event.select(F.to_json("event").alias("value"))
