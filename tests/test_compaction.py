import collections
import json

import pytest
from pyspark.sql import functions as F

from tierworks.operators import maintenance
from tierworks.operators.maintenance import COMPACTION_NOTE, compact_small_files, finish_compaction


def bag(df):
    return collections.Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def names(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def large_and_small(spark, path):
    """One file of random text and 12 of a few rows."""
    spark.range(4000, numPartitions=1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v")).write.parquet(path)
    spark.range(60, numPartitions=12).select("id", F.lit("few").alias("v")).write.mode("append").parquet(path)


def test_large_files_keep_their_names(spark, tmp_path):
    path = tmp_path / "t"
    large_and_small(spark, str(path))
    before, rows = names(path), bag(spark.read.parquet(str(path)))
    large = {n for n in before if (path / n).stat().st_size > 100_000}
    assert len(large) == 1 and len(before) == 13
    assert compact_small_files(spark, str(path), 50_000, 1_000_000) == (12, 1)
    after = names(path)
    assert len(after) == 2 and large < after and not (after - large) & before
    assert bag(spark.read.parquet(str(path))) == rows
    assert not [p for p in path.iterdir() if p.name.startswith("_comp")]
    # What is left alone has no company: another run changes nothing.
    assert compact_small_files(spark, str(path), 50_000, 1_000_000) == (0, 0) and names(path) == after


def test_partition_folders_and_late_columns(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, F.format_string("0%d", F.col("id") % 4)).alias("code"))
    rows.repartition(3).write.partitionBy("code").parquet(str(path))
    rows.filter("code = '02'").withColumn("more", F.lit("x")).repartition(3).write.mode("append").partitionBy("code").parquet(str(path))
    rows.filter("id = 1").withColumn("code", F.lit("alone")).coalesce(1).write.mode("append").partitionBy("code").parquet(str(path))
    whole = spark.read.option("mergeSchema", True)
    alone, expected = {n for n in names(path) if "alone" in n}, bag(whole.parquet(str(path)))
    replaced, made = compact_small_files(spark, str(path))
    assert made == 4 and replaced >= 8
    assert bag(whole.parquet(str(path))) == expected and alone < names(path)
    assert {n.split("/")[0] for n in names(path)} == {"code=01", "code=02", "code=03", "code=alone", "code=__HIVE_DEFAULT_PARTITION__"}


@pytest.mark.parametrize("fails", ["before the note", "first move", "first delete"])
def test_cut_off_anywhere(spark, tmp_path, monkeypatch, fails):
    path = tmp_path / "t"
    large_and_small(spark, str(path))
    rows = bag(spark.read.parquet(str(path)))

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(maintenance, {"before the note": "write_text", "first move": "move_file", "first delete": "delete_folder"}[fails], stop)
        with pytest.raises(OSError):
            compact_small_files(spark, str(path), 50_000, 1_000_000)
    if fails == "before the note":
        assert bag(spark.read.parquet(str(path))) == rows and not finish_compaction(spark, str(path))
        assert compact_small_files(spark, str(path), 50_000, 1_000_000) == (12, 1)
    else:
        plan = json.loads((path / COMPACTION_NOTE).read_text())
        assert len(plan["old"]) == 12 and finish_compaction(spark, str(path))
    assert len(names(path) - {n for n in names(path) if n.startswith("_")}) == 2
    assert bag(spark.read.parquet(str(path))) == rows and not finish_compaction(spark, str(path))


def test_nothing_to_do_and_stream_folders(spark, tmp_path):
    spark.range(3, numPartitions=1).write.parquet(str(tmp_path / "one"))
    assert compact_small_files(spark, str(tmp_path / "one")) == (0, 0)
    with pytest.raises(ValueError):
        compact_small_files(spark, str(tmp_path / "one"), 10, 5)
    (tmp_path / "one" / "_spark_metadata").mkdir()
    with pytest.raises(ValueError):
        compact_small_files(spark, str(tmp_path / "one"))
