import os

import pytest
from pyspark.sql import functions as F

from tierworks.operators.landing import batch_folder, land_batch, land_bronze
from tierworks.sources.catalog import read_table
from tierworks.sources.files import discover_sources, read_source, source_at


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")


def ids(spark, raw, name="s"):
    return sorted(int(r["id"]) for r in read_source(spark, source_at(spark, f"{raw}/{name}")).collect())


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_a_batch_that_lands_twice_counts_once(spark, tmp_path, fmt):
    raw = str(tmp_path)
    for _ in range(2):
        assert land_batch(frame(spark, 1, 2), "s", f"{raw}/s", "b/1", fmt=fmt) == "b/1"
    land_batch(frame(spark, 3), "s", f"{raw}/s", "b2", fmt=fmt)
    assert ids(spark, raw) == [1, 2, 3]


def test_a_batch_cut_off_half_way_does_not_count(spark, tmp_path):
    raw = str(tmp_path)
    land_batch(frame(spark, 1), "s", f"{raw}/s", "whole")
    broken = frame(spark, *range(20)).withColumn("name", F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        land_batch(broken, "s", f"{raw}/s", "cut")
    # Part files moved into place by a commit that did not get to its end.
    folder = batch_folder(f"{raw}/s", "half")
    frame(spark, 7, 8).write.option("header", True).csv(folder)
    os.remove(f"{folder}/_SUCCESS")
    assert ids(spark, raw) == [1]
    land_batch(frame(spark, 7, 8), "s", f"{raw}/s", "half")
    land_batch(frame(spark, *range(2, 5)), "s", f"{raw}/s", "cut")
    assert ids(spark, raw) == [1, 2, 3, 4, 7, 8]


def test_foreign_files_beside_batches(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "s").mkdir(parents=True)
    (raw / "s" / "part-1.csv").write_text("name,id\nx,9\n")
    land_batch(frame(spark, 1), "s", f"{raw}/s", "b1")
    (source,) = discover_sources(spark, str(raw))
    assert source.csv_files >= 2 and len(source.folders) == 2
    assert ids(spark, str(raw)) == [1, 9]
    bronze = str(tmp_path / "bronze")
    assert [tuple(r) for r in land_bronze(spark, str(raw), bronze).collect()] == [("s", 2)]
    assert read_table(spark, f"{bronze}/s").count() == 2


def test_batch_names_do_not_clash():
    names = {batch_folder("/r", b) for b in ("a/b", "a%2Fb", "a b", "ä", "a_b")}
    assert len(names) == 5 and all("/" not in n[3:] for n in names)
