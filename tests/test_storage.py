import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierworks.operators.benchmark import benchmark_summary
from tierworks.operators.maintenance import compact, repartition_table, retain
from tierworks.operators.storage import (
    best_variant,
    bytes_per_column,
    column_storage,
    file_inventory,
    layout_report,
    layout_totals,
    orphan_files,
)
from tierworks.sources.listing import parquet_files
from tierworks.sources.runs import RUN_SCHEMA

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def bag(df):
    return collections.Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def files_in(path):
    return [p for p in path.rglob("*.parquet")]


def test_compact_keeps_rows(spark, tmp_path):
    df = spark.read.parquet(ORDERS)
    df.repartition(20).write.parquet(str(tmp_path / "many"))
    few = compact(spark, str(tmp_path / "many"), str(tmp_path / "few"))
    assert len(files_in(tmp_path / "many")) == 20 and len(files_in(tmp_path / "few")) == 1
    assert bag(few) == bag(df)
    # A smaller target gives more files; the size of a file on disk plus its opening cost counts.
    compact(spark, str(tmp_path / "many"), str(tmp_path / "some"), target_bytes=400 * 1024)
    assert 2 <= len(files_in(tmp_path / "some")) <= 6
    with pytest.raises(Exception):
        compact(spark, str(tmp_path / "many"), str(tmp_path / "few"))


def test_compact_and_repartition_partitioned_tables(spark, tmp_path):
    df = spark.read.parquet(ORDERS).withColumn("code", F.format_string("0%d", F.col("o_orderkey") % 3))
    df.repartition(6).write.partitionBy("code").parquet(str(tmp_path / "src"))
    compact(spark, str(tmp_path / "src"), str(tmp_path / "dst"), partition_by=["code"])
    assert {p.name for p in (tmp_path / "dst").iterdir() if p.is_dir()} == {"code=00", "code=01", "code=02"}
    assert len(files_in(tmp_path / "dst")) == 3
    again = repartition_table(spark, str(tmp_path / "src"), str(tmp_path / "by-status"), ["o_orderstatus"])
    assert again.count() == df.count()
    assert {p.name[:14] for p in (tmp_path / "by-status").iterdir() if p.is_dir()} == {"o_orderstatus="}


def test_retention_halves_add_up(spark):
    now = dt.datetime(2024, 3, 1)
    rows = [(i, now - dt.timedelta(days=i)) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, at timestamp")
    kept, archived = retain(df, "at", now, 30)
    assert kept.count() == 32 and archived.count() == 29
    assert bag(kept) + bag(archived) == bag(df)


def test_inventory(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "t"))
    found = file_inventory(spark, str(tmp_path / "t")).collect()
    assert len(found) == 4 and sum(r["records"] for r in found) == 100
    assert all(r["is_small"] for r in found)


def test_orphans_are_the_uncommitted_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\n2\n")
    out = str(tmp_path / "out")
    query = spark.readStream.text(str(tmp_path / "in")).writeStream.format("parquet").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "log")).start(out).awaitTermination()
    soon = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    assert orphan_files(spark, out, 0, soon).count() == 0
    spark.range(5).coalesce(1).write.mode("append").parquet(out)
    assert orphan_files(spark, out, 0, soon).count() == 1
    assert orphan_files(spark, out, 7, soon).count() == 0
    assert spark.read.parquet(out).count() == 2


def test_layouts(spark, tmp_path):
    df = spark.range(20_000).select(
        F.md5(F.col("id").cast("string")).alias("event_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.date_format(F.timestamp_seconds(F.col("id") / 2 + 1.7e9), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ts"),
    )
    report = layout_report(spark, df, str(tmp_path / "layouts")).checkpoint()
    used = {(r["variant"], r["column"]): r["encodings"] for r in report.collect()}
    assert "PLAIN_DICTIONARY" in used["defaults", "customer_id"] or "RLE_DICTIONARY" in used["defaults", "customer_id"]
    assert "DICTIONARY" not in used["no-dict", "ts"]
    assert "DELTA_BYTE_ARRAY" in used["delta-text", "ts"]
    assert set(report.select("codec").distinct().first()) == {"ZSTD"}
    best = {r["column"]: r for r in best_variant(report).collect()}
    assert max(best, key=lambda c: best[c]["defaults"]) == "event_id"
    assert best["ts"]["best"] == "delta-text" and best["ts"]["delta_text"] < best["ts"]["no_dict"]
    assert abs(sum(r["baseline_share"] for r in best.values()) - 1) < 1e-9
    totals = {r["variant"]: r["against_baseline"] for r in layout_totals(report).collect()}
    assert totals["defaults"] == 0 and set(totals) == {"defaults", "no-dict", "delta-text"}
    assert bytes_per_column(report).count() == 9


def test_every_row_group_is_reported(spark, tmp_path):
    spark.range(50_000).coalesce(1).write.option("parquet.block.size", 64 * 1024).parquet(str(tmp_path / "t"))
    report = column_storage(spark, parquet_files(spark, str(tmp_path / "t")))
    assert report.count() > 1 and report.agg(F.sum("values")).first()[0] == 50_000


@pytest.mark.parametrize("rows_per_task", [None, 1])
def test_benchmark_summary(spark, rows_per_task):
    def run(impl, excl, incl, rows, resources):
        return (impl, "r", "t", [], (excl, incl, rows, 0), [], "", resources)

    records = [
        ("go-1", run("go", 900.0, 990.0, 10, (1.0, 1.0, 1.0))),
        ("go-2", run("go", 100.0, 110.0, 20, (30.0, 50.0, 5.0))),
        ("go-3", run("go", 300.0, 330.0, 30, (10.0, 70.0, 5.0))),
        ("java-1", run("java", 0.0, 0.0, 7, None)),
    ]
    df = spark.createDataFrame([(*r, f) for f, r in records], f"{RUN_SCHEMA}, file_name STRING")
    assert [tuple(r) for r in benchmark_summary(df, rows_per_task).collect()] == [
        ("java", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 7, 1, 1),
        ("go", 220.0, 200.0, 100.0, 65.0, 65.0 / 220.0, 20.0, 20, 2, 3),
    ]
