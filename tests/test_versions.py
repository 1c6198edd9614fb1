import datetime as dt
import time

import pytest

from tierworks.operators.landing import expire_versions, publish, read_latest, read_version, replace_table, unfinished_versions, version_times, versions
from tierworks.sources.catalog import read_table


def frame(spark, n):
    return spark.range(n)


def test_versions_by_number_and_time(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_version(spark, root, 1) is None
    for n in (1, 2, 3):
        publish(frame(spark, n), root)
        time.sleep(1.1)
    times = [at for _, _, at in version_times(spark, root)]
    assert [read_version(spark, root, n).count() for n in (1, 2, 3)] == [1, 2, 3]
    assert read_version(spark, root, 4) is None
    assert read_version(spark, root, as_of=times[1]).count() == 2
    assert read_version(spark, root, as_of=times[1] - dt.timedelta(milliseconds=1)).count() == 1
    assert read_version(spark, root, as_of=times[0] - dt.timedelta(days=1)) is None
    with pytest.raises(ValueError):
        read_version(spark, root)


def test_expiry_reports_first_and_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3):
        publish(frame(spark, n), root)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=3)
    assert len(expire_versions(spark, root, keep=2, now=later)) == 1
    assert expire_versions(spark, root, keep=1, older_than_days=5, now=later) == []
    assert len(versions(spark, root)) == 3
    assert len(expire_versions(spark, root, keep=0, now=later, apply=True)) == 2
    assert len(versions(spark, root)) == 1 and read_latest(spark, root).count() == 3


def test_a_failed_write_leaves_readers_untouched(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark, 5), root)
    with pytest.raises(Exception):
        publish(frame(spark, 9).selectExpr("CASE WHEN id = 7 THEN raise_error('lost') ELSE id END AS id"), root)
    assert read_latest(spark, root).count() == 5 and len(versions(spark, root)) == 1


def test_unfinished_versions_are_reported(spark, tmp_path):
    root = str(tmp_path / "t")
    assert unfinished_versions(spark, root) == []
    publish(frame(spark, 5), root)
    with pytest.raises(Exception):
        publish(frame(spark, 9).selectExpr("CASE WHEN id = 7 THEN raise_error('lost') ELSE id END AS id"), root)
    (tmp_path / "t" / "version=000000000009").mkdir()
    assert [p.rsplit("=", 1)[1] for p in unfinished_versions(spark, root)][-1] == "000000000009"
    assert all(p not in versions(spark, root) for p in unfinished_versions(spark, root))


BROKEN = "CASE WHEN id = 7 THEN raise_error('lost') ELSE id END AS id"


def test_replacing_a_path_in_one_step(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_table(frame(spark, 3), root)
    before = read_table(spark, root)  # a reader that began earlier
    replace_table(read_table(spark, root).unionByName(frame(spark, 2)), root)  # reads what it replaces
    assert (before.count(), read_table(spark, root).count()) == (3, 5)
    with pytest.raises(Exception, match="lost"):
        replace_table(frame(spark, 9).selectExpr(BROKEN), root)
    assert read_table(spark, root).count() == 5
    replace_table(frame(spark, 1), root, keep=1)
    assert len(versions(spark, root)) == 1 and read_table(spark, root).count() == 1


def test_replacing_a_name_in_one_step(spark, tmp_path):
    spark.sql(f"CREATE DATABASE swapped LOCATION '{tmp_path}/swapped'")
    replace_table(frame(spark, 4).selectExpr("id", "id % 2 AS half"), "swapped.t", ["half"])
    assert spark.table("swapped.t").count() == 4
    with pytest.raises(Exception, match="lost"):
        replace_table(frame(spark, 9).selectExpr(BROKEN), "swapped.t")
    assert spark.table("swapped.t").count() == 4
    replace_table(spark.table("swapped.t").filter("half = 1"), "swapped.t")
    assert sorted(r.id for r in spark.table("swapped.t").collect()) == [1, 3]
    frame(spark, 2).write.saveAsTable("swapped.stored")
    with pytest.raises(ValueError, match="stored as a table"):
        replace_table(frame(spark, 2), "swapped.stored")
