import json

from pyspark.sql import types as T

from tierworks.sources.schemas import drift, kept_schema, parsed, read_json_kept, widened


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def test_later_fields_are_rescued(spark, tmp_path):
    source, schema = tmp_path / "s", str(tmp_path / "schemas" / "s.json")
    (tmp_path / "schemas").mkdir()
    put(source, "1.jsonl", {"id": 1, "name": "a"}, {"id": 2, "name": None})
    first = read_json_kept(spark, str(source), schema)
    assert first.columns == ["id", "name", "_rescued"] and first.filter("_rescued IS NOT NULL").count() == 0
    put(source, "2.jsonl", {"id": 3, "name": "c", "shelf": {"row": 7}, "price": 1.5}, {"id": "many", "name": "d"}, "", "[1]", "{broken", {"id": 4, "price": 2, "note": "x y"})
    rows = {r["name"] or r["id"] or r["_rescued"]: r for r in read_json_kept(spark, str(source), schema).collect()}
    assert len(rows) == 7
    assert json.loads(rows["c"]["_rescued"]) == {"shelf": '{"row":7}', "price": "1.5"}
    assert rows["d"]["id"] is None and json.loads(rows["d"]["_rescued"]) == {"id": "many"}
    assert sorted(json.loads(k)["_corrupt_line"] for k in rows if isinstance(k, str) and "_corrupt" in k) == ["[1]", "{broken"]
    assert kept_schema(spark, schema).fieldNames() == ["id", "name"]


def test_drift_and_widening(spark, tmp_path):
    source, schema = tmp_path / "s", str(tmp_path / "s.json")
    put(source, "1.jsonl", {"id": 1})
    read_json_kept(spark, str(source), schema)
    put(source, "2.jsonl", {"id": 2, "price": 1.5, "shelf": {"row": 7}, "note": "x"}, {"id": 3, "price": 2, "note": "y"}, {"id": "z"})
    df = read_json_kept(spark, str(source), schema)
    assert sorted(map(tuple, drift(df).collect())) == [("id", 1), ("note", 2), ("price", 2), ("shelf", 1)]
    wide = widened(spark, df, kept_schema(spark, schema))
    assert {f.name: f.dataType.simpleString() for f in wide} == {"id": "bigint", "note": "string", "price": "double", "shelf": "struct<row:bigint>"}
    lines = spark.read.text(str(source))
    again = parsed(lines, wide)
    assert sorted((r["price"] or 0, r["note"] or "", r["shelf"] and r["shelf"]["row"]) for r in again.collect())[-1] == (2.0, "y", None)
    assert [json.loads(r["_rescued"]) for r in again.filter("_rescued IS NOT NULL").collect()] == [{"id": "z"}]


def test_schema_without_fields(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ("{}",)], "value string")
    assert sorted(str(r["_rescued"]) for r in parsed(lines, T.StructType([])).collect()) == ["None", '{"a":"1"}']
