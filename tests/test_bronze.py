import json
import logging

import pytest
from pyspark.sql import functions as F

from tierworks.operators.conform import conform, stringify
from tierworks.operators.contract import contract_check, contract_projection, with_contract
from tierworks.operators.landing import full_refresh, land_batch, land_bronze, publish, read_latest, timed_landing
from tierworks.sources.catalog import ensure_namespace, list_tables, read_table, resolve
from tierworks.sources.files import csv_headers, discover_sources, read_csv_source, read_json_source
from tierworks.sources.runs import read_runs, run_files
from tierworks.sources.synthetic import SHAPES, synth_source


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        stem, _, ending = name.rpartition("_")
        (folder / f"{stem}.{ending}").write_text(text)
    return str(folder)


def test_csv_files_match_by_header_name(spark, tmp_path):
    path = write(
        tmp_path / "crm",
        part1_csv='id,name,region\n1,"a, quoted",na\n2,,emea\n',
        part2_csv="region,id,name,extra\napac,3,c,x\n",
        part3_csv="id,name,region\n",
        part4_csv="",
    )
    df = read_csv_source(spark, path)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows_of(df.select("id", "name", "region", "extra")) == [
        ("1", "a, quoted", "na", None),
        ("2", None, "emea", None),
        ("3", "c", "apac", "x"),
    ]


def test_csv_headers_of_one_file_and_repeated_names(spark, tmp_path):
    path = write(tmp_path / "one", part1_csv="a,b\n1,2\n")
    assert rows_of(read_csv_source(spark, path)) == [("1", "2")]
    path = write(tmp_path / "twice", part1_csv="a,a\n1,2\n", part2_csv="a,a\n3,4\n")
    assert read_csv_source(spark, path).columns == ["a0", "a1"]


def test_headers_through_spark_alone(spark, tmp_path, monkeypatch):
    import tierworks.sources.files as files

    path = write(tmp_path / "crm", part1_csv='"id",name\n1,a\n2,b\n', part2_csv="name,id\nc,3\n")
    monkeypatch.setattr(files, "arrow_readable", lambda uri: False)
    found = files.source_at(spark, path)
    assert sorted(r["header"] for r in csv_headers(spark, found).collect()) == [["id", "name"], ["name", "id"]]
    assert rows_of(read_csv_source(spark, path)) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_json_types_and_strings(spark, tmp_path):
    lines = '{"a": 1, "b": null}\n\n{"a": 2.5, "c": true}\n{"a": 3}\n'
    path = write(tmp_path / "web", part1_jsonl=lines)
    inferred = read_json_source(spark, path)
    assert dict(inferred.dtypes)["a"] == "double"
    texts = read_json_source(spark, path, as_strings=True)
    assert set(dict(texts.dtypes).values()) == {"string"}
    assert rows_of(texts.select("a")) == [("1",), ("2.5",), ("3",)]
    assert read_json_source(spark, path, schema="a double").count() == 3


def test_discovery(spark, tmp_path, caplog):
    write(tmp_path / "raw" / "a", part1_csv="x\n1\n")
    write(tmp_path / "raw" / "b", part1_jsonl='{"x": 1}\n')
    (tmp_path / "raw" / "empty").mkdir()
    root = str(tmp_path / "raw")
    assert [(s.name, s.empty) for s in discover_sources(spark, root)] == [("a", False), ("b", False), ("empty", True)]
    with caplog.at_level(logging.WARNING):
        assert [s.name for s in discover_sources(spark, root, ["b", "nope"])] == ["b"]
    assert "nope" in caplog.text
    with pytest.raises(FileNotFoundError):
        discover_sources(spark, str(tmp_path / "missing"))


def test_landing_is_a_full_refresh(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "bronze")
    write(raw / "crm", part1_csv="id,v\n1,a\n2,b\n")
    write(raw / "mixed", part1_csv="id,v\n1,a\n", part2_jsonl='{"v": "b", "id": 2}\n')
    (raw / "empty").mkdir()
    for _ in range(2):
        assert rows_of(land_bronze(spark, str(raw), out)) == [("crm", 2), ("empty", 0), ("mixed", 2)]
    assert rows_of(read_table(spark, f"{out}/mixed").select("id", "v")) == [("1", "a"), ("2", "b")]
    write(raw / "crm", part2_csv="id,v\n3,c\n")
    assert rows_of(land_bronze(spark, str(raw), out, only=["crm"])) == [("crm", 3)]


def test_landing_into_a_namespace(spark, tmp_path):
    write(tmp_path / "raw" / "crm", part1_csv="id,v\n1,a\n2,b\n")
    land_bronze(spark, str(tmp_path / "raw"), "bronze_test")
    land_bronze(spark, str(tmp_path / "raw"), "bronze_test")
    assert rows_of(list_tables(spark, "bronze_test")) == [("bronze_test", "crm")]
    assert read_table(spark, "bronze_test.crm").count() == 2
    assert resolve(spark, {"customers": "bronze_test.crm"})["customers"].count() == 2
    ensure_namespace(spark, "bronze_test")


def test_batches_append(spark, tmp_path):
    path = str(tmp_path / "crm")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    first = land_batch(df, "crm", path)
    second = land_batch(df, "crm", path, ingested_at="2024-01-01T00:00:00+00:00")
    landed = read_csv_source(spark, path)
    assert landed.select("_batch_id").distinct().count() == 2 and first != second
    assert rows_of(landed.select("_source").distinct()) == [("crm",)]


def test_partitioned_refresh_and_versions(spark, tmp_path):
    df = spark.range(100).withColumn("region", F.when(F.col("id") < 80, "na").otherwise("emea"))
    full_refresh(df, str(tmp_path / "t"), ["region"], max_records_per_file=30)
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"region=na", "region=emea"}
    root = str(tmp_path / "versions")
    assert read_latest(spark, root) is None
    publish(df, root, ["region"])
    publish(read_latest(spark, root).filter("id < 50"), root, ["region"])
    assert read_latest(spark, root).count() == 50
    (tmp_path / "versions" / "version=000000000009").mkdir()  # a write that did not finish
    assert read_latest(spark, root).count() == 50


def test_conform_splits(spark):
    raw = spark.createDataFrame([("1", "10.5", "x"), ("abc", "1", "y"), (None, "zz", "z"), ("12.5", None, "w")], "id string, amount string, other string")
    good, rejected = conform(raw, {"id": "int", "amount": "double"}, required=["id"])
    assert rows_of(good) == [(1, 10.5, "x")]
    assert {r["other"]: r["_reject_reason"] for r in rejected.collect()} == {
        "y": "id: not int",
        "z": "amount: not double; id: missing",
        "w": "id: not int",
    }
    assert good.count() + rejected.count() == raw.count()
    assert set(dict(stringify(good).dtypes).values()) == {"string"}


def test_contract(spark):
    df = with_contract(spark.range(5), "s", "b", F.when(F.col("id") != 2, F.col("id").cast("string")))
    assert contract_projection(df, 2).collect()[0] == ("s", "b", "0")
    assert rows_of(contract_check({"ok": df, "bare": spark.range(3)})) == [
        ("bare", "_source,_batch_id,_ingested_at", 0),
        ("ok", "", 1),
    ]


def test_run_records(spark, tmp_path):
    write(tmp_path / "raw" / "crm", part1_csv="id,v\n1,a\n2,b\n")
    record = timed_landing(spark, str(tmp_path / "raw"), str(tmp_path / "bronze")).first().asDict(True)
    assert record["totals"]["rows"] == 2 and record["per_source"][0]["source"] == "crm"
    assert record["totals"]["bytes_parquet"] > 0
    runs = tmp_path / "runs"
    write(runs, run1_json=json.dumps(record, indent=2), run2_json="{not json", run3_json='{"run_id": "x"}')
    found = {r["file_name"]: r["impl"] for r in read_runs(spark, str(runs)).collect()}
    assert found == {"run1.json": "spark", "run3.json": "unknown"}


def test_synthetic_rows_are_repeatable(spark):
    one = synth_source(spark, "web_events", 50, days=3, seed=1, batch_id="b", partitions=2)
    assert one.columns == [*SHAPES["web_events"][1], "_source", "_ingested_at", "_batch_id"]
    same = {"now": None}
    import datetime as dt

    same["now"] = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
    a = synth_source(spark, "crm_customers", 50, days=3, seed=1, batch_id="b", partitions=2, **same)
    b = synth_source(spark, "crm_customers", 50, days=3, seed=1, batch_id="b", partitions=7, **same)
    assert rows_of(a) == rows_of(b)
    assert a.filter("_ingested_at < '2024-01-28' OR _ingested_at > '2024-01-31T00:00:00.000000+00:00'").count() == 0
    assert a.select("id").distinct().count() == 50
    assert {r[0] for r in a.select("segment").distinct().collect()} <= {"smb", "mid", "ent"}
    assert one.filter("customer_id < 0 OR customer_id >= 50").count() == 0


def test_run_files_say_why(spark, tmp_path):
    good = json.dumps({"run_id": "a", "totals": {"wall_ms_excl_startup": 1.0}})
    write(
        tmp_path / "runs", good_json=good, two_json=f"[{good}, {good}]", torn_json=good[:-9], words_json="not a record",
        wrong_json='{"run_id": "b", "totals": "lost"}', bare_json='{"run_id": "c"}', list_json="[]", blank_json="  \n", other_txt=good,
    )
    (tmp_path / "runs" / "none.json").write_text("")
    found = {r.file_name: (r.records, r.reason) for r in run_files(spark, str(tmp_path / "runs")).collect()}
    assert found == {
        "good.json": (1, None), "two.json": (2, None), "torn.json": (0, "malformed"), "words.json": (0, "malformed"),
        "wrong.json": (0, "malformed"), "bare.json": (1, "no totals"), "list.json": (0, "no record"),
        "blank.json": (0, "no record"), "none.json": (0, "empty"),
    }
    # Whether a record counts does not depend on what is asked of it.
    assert read_runs(spark, str(tmp_path / "runs")).select("notes").count() == 4
    sizes = {r.file_name: r.file_bytes for r in run_files(spark, str(tmp_path / "runs")).collect()}
    assert sizes["good.json"] == len(good) and sizes["none.json"] == 0
