"""Sizes and file counts choose how work is laid out; both ways must give the same rows."""

import math

import pytest
from pyspark.sql import functions as F

from tierworks.functions import MONEY
from tierworks.operators.aggregates import with_rank_and_share
from tierworks.operators.benchmark import medians_by
from tierworks.operators.maintenance import compact
from tierworks.operators.storage import file_inventory, orphan_files
from tierworks.operators.windows import group_max_and_delta, running_total
from tierworks.plans.sizing import measure
from tierworks.sources.files import column_names, read_csv_source
from tierworks.streaming.events import split_event_times, stream_dedupe

ROWS = [("a", None)] * 6 + [("b", 1.0), ("b", 2.0), ("b", 2.0), ("b", None), ("c", 7.5), (None, 3.0), (None, 5.0), ("d", 4.0)]


def plain(rows):
    return sorted([tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows], key=repr)


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_medians(spark, limit):
    df = spark.createDataFrame(ROWS, "k string, v double")
    assert plain(medians_by(df, ["k"], ["v"], limit).collect()) == plain(medians_by(df, ["k"], ["v"]).collect())


def test_ranks_of_nan_null_and_ties(spark):
    values = [1.0, 2.0, 2.0, float("nan"), None, -0.0, 0.0, float("-inf"), None]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n bigint, v double")
    small, large = (with_rank_and_share(df, "v", one_task_rows=m).select("n", "revenue_rank").collect() for m in (None, 1))
    assert plain(small) == plain(large)


def test_ranks_of_the_smallest_integer(spark):
    df = spark.createDataFrame([(-(2**63),), (5,), (2**63 - 1,)], "v bigint")
    small, large = (with_rank_and_share(df.select("v", (F.col("v") % 7).alias("w")), "v", one_task_rows=m, sum_type="decimal(38,0)") for m in (None, 1))
    assert plain(small.select("v", "revenue_rank").collect()) == plain(large.select("v", "revenue_rank").collect())


def test_small_values_are_added_as_they_are(spark):
    df = spark.createDataFrame([("a", n, 0.004) for n in range(3)], "k string, n bigint, v double")
    assert [round(r.running_total, 6) for r in running_total(df, ["k"], ["n"], "v").orderBy("n").collect()] == [0.004, 0.008, 0.012]
    assert all(abs(r.delta_from_avg) < 1e-12 for r in group_max_and_delta(df, ["k"], "v").collect())
    assert {r.running_total for r in running_total(df, ["k"], ["n"], "v", sum_type=MONEY).collect()} == {0.0}


@pytest.mark.parametrize(
    ("header", "names"),
    [("id,name,", ["id", "name", "_c2"]), ("id,ID", ["id0", "ID1"]), ("id0,id,ID", ["id0", "id1", "ID2"]), ('"a,b",c', ["a,b", "c"]), ('"a""b",c', ['a"b', "c"])],
)
def test_csv_names_do_not_hang_on_the_number_of_files(spark, tmp_path, header, names):
    cells = ",".join("v" for _ in names)
    for count in (1, 2):
        folder = tmp_path / f"{count}"
        folder.mkdir()
        for n in range(count):
            (folder / f"part{n}.csv").write_text(f"{header}\n{cells}\n")
        df = read_csv_source(spark, str(folder))
        assert df.columns == names and df.count() == count


def test_column_names_are_unique():
    assert column_names(["a", "A", "a0"]) == ["a0", "A1", "a0_"]


def test_csv_files_of_other_header_and_line_breaks(spark, tmp_path):
    (tmp_path / "part 1+.csv").write_text('id,name\n1,"a\nb"\n')
    (tmp_path / "part2.csv").write_text("NAME,id,more\nc,2,x\n")
    df = read_csv_source(spark, str(tmp_path), multi_line=True)
    assert sorted(df.select("id", "name", "more").collect(), key=lambda r: r.id) == [("1", "a\nb", None), ("2", "c", "x")]


def test_compaction_keeps_a_column_that_came_later(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    spark.createDataFrame([(1,)], "a bigint").write.parquet(src)
    spark.createDataFrame([(2, 3)], "a bigint, b bigint").write.mode("append").parquet(src)
    assert sorted(compact(spark, src, dst).select("a", "b").collect()) == [(1, None), (2, 3)]


def test_inventory_lists_files_without_rows(spark, tmp_path):
    spark.createDataFrame([(1,)], "a bigint").coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([], "a bigint").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    found = file_inventory(spark, str(tmp_path / "t")).collect()
    assert sorted(r.records for r in found) == [0, 1] and all(r.file_bytes > 0 and r.is_small for r in found)


def test_orphans_of_a_partitioned_sink(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    df = spark.createDataFrame([(n, n % 2) for n in range(6)], "a bigint, p bigint")
    df.write.parquet(src)
    writer = spark.readStream.schema(df.schema).parquet(src).writeStream.partitionBy("p").format("parquet")
    writer.option("path", out).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    later = F.current_timestamp() + F.make_dt_interval(F.lit(1))
    assert orphan_files(spark, out, 0, later).count() == 0
    df.filter("p = 1").coalesce(1).write.mode("append").partitionBy("p").parquet(out)
    assert orphan_files(spark, out, 0, later).count() == 1
    with pytest.raises(ValueError, match="_spark_metadata"):
        orphan_files(spark, src, 0, later)


def test_unreadable_times_do_not_stop_the_stream(spark, tmp_path):
    rows = [("1", "2024-01-01 00:00:00"), ("1", "2024-01-01 00:00:01"), ("2", "no time"), ("3", None)]
    src = str(tmp_path / "src")
    df = spark.createDataFrame(rows, "k string, at string")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    query = stream_dedupe(stream, ["k"], "at", "1 hour").writeStream.format("memory").queryName("deduped_times").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.k for r in spark.table("deduped_times").collect()] == ["1"]
    good, bad = split_event_times(df, "at")
    assert good.count() == 2 and sorted(r.k for r in bad.collect()) == ["2", "3"]


def test_measured_bytes_of_nested_values(spark):
    df = spark.createDataFrame([("x" * 100, [1, 2, 3], {"k": "v" * 50}, (1, "y" * 30), None)], "s string, a array<bigint>, m map<string,string>, t struct<i:int,u:string>, n string")
    assert 200 < measure(df).bytes < 1000
    assert measure(df.limit(0)).bytes == 0
