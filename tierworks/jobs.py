"""The medallion jobs end to end: seed, bronze, silver, gold, orders stream.

    spark-submit -m tierworks.jobs seed   --raw data/raw --rows 200 --days 30
    spark-submit -m tierworks.jobs bronze --raw data/raw --bronze lake/bronze
    spark-submit -m tierworks.jobs silver --bronze lake/bronze --silver lake/silver
    spark-submit -m tierworks.jobs gold   --bronze lake/bronze --silver lake/silver --gold lake/gold
    spark-submit -m tierworks.jobs stream --bronze lake/bronze --brokers kafka:9092 --checkpoint lake/log

Bronze, facts and gold are rebuilt in full by each run, each table in one step; a run that fails leaves the tables
that it did not get to as they were. The dimension gets a new version per run.
"""

from __future__ import annotations

import argparse
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierworks.functions import MONEY, ingest_instant
from tierworks.operators.aggregates import revenue_by, with_rank_and_share
from tierworks.operators.conform import conform
from tierworks.operators.landing import land_batch, land_bronze, publish, read_latest, replace_table
from tierworks.operators.scd2 import scd2_apply, scd2_snapshot
from tierworks.operators.windows import newest_per_key
from tierworks.plans.workspace import settle
from tierworks.session import session
from tierworks.sources.catalog import read_table
from tierworks.sources.synthetic import SHAPES, synth_source
from tierworks.streaming.events import stream_source, stream_with_dead_letters

KEY, TRACKED = ["id"], ["segment", "region"]
CUSTOMER = ["id", "name", "segment", "region"]


def seed(spark: SparkSession, raw: str, rows: int, days: int = 0, number: int = 0) -> str:
    """Append one batch of every source below ``raw``; returns its batch id."""
    batch_id, now = str(uuid.uuid4()), datetime.now(timezone.utc)

    def one(name: str) -> None:
        df = synth_source(spark, name, rows, days, number, now=now, batch_id=batch_id)
        land_batch(df, name, f"{raw}/{name}", batch_id, fmt=SHAPES[name][0])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, SHAPES))
    return batch_id


def newest_customers(raw_customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(newest row per customer, rejected rows) out of all landed batches.

    Times are compared as instants; text that is no time sorts after all of them.
    """
    typed, rejected = conform(raw_customers, {"id": "int"}, required=["id"])
    timed = typed.withColumn("_instant", ingest_instant("_ingested_at"))
    newest = newest_per_key(timed, KEY, ["_instant", "_ingested_at", "_batch_id"])
    return newest.select(*CUSTOMER), rejected


def silver(spark: SparkSession, bronze_root: str, silver_root: str, as_of: Column | None = None) -> None:
    """Version the customers twice (plain and snapshot names) and conform employees and invoices.

    Rejected rows are kept below ``_rejected``.
    """
    as_of = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of
    incoming, rejected = newest_customers(read_table(spark, f"{bronze_root}/crm_customers"))
    replace_table(rejected, f"{silver_root}/_rejected/crm_customers")
    incoming = settle(incoming)

    plain, snapshot = f"{silver_root}/dim_customer", f"{silver_root}/dim_customer_scd2"
    before = read_latest(spark, plain)
    after = scd2_apply(before, incoming, KEY, TRACKED, as_of)
    # Later versions keep the layout of the one they were read from, so they are not shuffled to write.
    publish(after, plain, ["region"], rebalance=before is None)
    before = read_latest(spark, snapshot)
    publish(scd2_snapshot(before, incoming, KEY, TRACKED, as_of), snapshot)

    facts = {
        "hr_employees": ({"emp_id": "int", "salary": "int"}, ["emp_id", "dept", "salary"]),
        "billing_invoices": (
            {"invoice_id": "int", "customer_id": "int", "amount": "double"},
            ["invoice_id", "customer_id", "amount", "status"],
        ),
    }
    for name, (types, columns) in facts.items():
        good, bad = conform(read_table(spark, f"{bronze_root}/{name}"), types)
        replace_table(good.select(*columns), f"{silver_root}/{name}")
        replace_table(bad, f"{silver_root}/_rejected/{name}")


def gold(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str) -> DataFrame:
    """``revenue_by_segment`` from conformed invoices and the current customers.

    Invoices that do not fit their types are in silver's ``_rejected``, with the reason.
    """
    dim = read_latest(spark, f"{silver_root}/dim_customer_scd2")
    invoices = read_table(spark, f"{silver_root}/billing_invoices")
    target = f"{gold_root}/revenue_by_segment"
    replace_table(with_rank_and_share(revenue_by(invoices, dim, "segment"), "revenue", sum_type=MONEY), target)
    return read_table(spark, target)


def stream(
    spark: SparkSession,
    bronze_root: str,
    checkpoint: str,
    kind: str = "kafka",
    available_now: bool = False,
    **options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Append order events to bronze until stopped, and unreadable payloads next to them."""
    return stream_with_dead_letters(
        stream_source(spark, kind, **options),
        f"{bronze_root}/orders",
        f"{bronze_root}/_dead_letters/orders",
        checkpoint,
        available_now=available_now,
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["seed", "bronze", "silver", "gold", "stream"])
    for name in ("raw", "bronze", "silver", "gold", "checkpoint", "brokers"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--topic", default="orders")
    parser.add_argument("--rows", type=int, default=50)
    parser.add_argument("--days", type=int, default=0)
    parser.add_argument("--seed", type=int, default=None)
    args = parser.parse_args()
    spark = session(f"tierworks-{args.job}")
    if args.job == "seed":
        number = args.seed if args.seed is not None else uuid.uuid4().int % 2**31
        print(seed(spark, args.raw, args.rows, args.days, number))
    elif args.job == "bronze":
        land_bronze(spark, args.raw, args.bronze).show(100, False)
    elif args.job == "silver":
        silver(spark, args.bronze, args.silver)
    elif args.job == "gold":
        gold(spark, args.bronze, args.silver, args.gold).show(100, False)
    else:
        kafka = {"kafka.bootstrap.servers": args.brokers, "subscribe": args.topic}
        stream(spark, args.bronze, args.checkpoint, **kafka)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
