"""JSON-lines sources under a schema that is kept: read in one pass, with what does not fit rescued.

The schema of a source is inferred when it is first read, and stored. Later reads use it as it is. A field that it does
not have, a value that does not fit its field, and a line that is no JSON object come back in one more column, so nothing
that arrives is lost, and a new field neither needs a second pass over the data nor changes the table's columns until
somebody widens the schema.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierworks.sources.files import GLOBS, Source, read_json_files, source_at
from tierworks.sources.listing import exists, read_text, write_text

RESCUED, CORRUPT = "_rescued", "_corrupt_line"


def kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The stored schema, None where there is none yet."""
    return T.StructType.fromJson(json.loads(read_text(spark, path))) if exists(spark, path) else None


def keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_text(spark, path, json.dumps(schema.jsonValue()))


def read_json_kept(spark: SparkSession, source: Source | str, schema_path: str) -> DataFrame:
    """The rows of a JSON-lines source in the columns of its kept schema, and ``_rescued``: a JSON object, or NULL.

    Without a kept schema it is inferred (one more pass over the data, this once) and kept. ``_rescued`` holds fields that the
    schema lacks, values of another type than their field's, and whole lines that are no object, as ``_corrupt_line``. Blank
    lines are no rows.
    """
    own = source_at(spark, source) if isinstance(source, str) else source
    schema = kept_schema(spark, schema_path)
    if schema is None:
        schema = read_json_files(spark, own).schema
        keep_schema(spark, schema_path, schema)
    lines = spark.read.option("pathGlobFilter", GLOBS["json"]).text(list(own.folders)).filter(F.trim("value") != "")
    return parsed(lines, schema).drop("value")


def parsed(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """``lines`` with the fields of the JSON in ``value``, and ``_rescued``; for batches and streams."""
    fields = F.from_json(value, T.MapType(T.StringType(), T.StringType()))
    read = lines.select("*", F.from_json(value, schema).alias("_row"), fields.alias("_fields"))
    known = F.array(*[F.lit(f.name) for f in schema.fields]) if schema.fields else F.array().cast("array<string>")
    lost = [F.when(F.col("_row").getField(f.name).isNull(), F.lit(f.name)) for f in schema.fields]
    unread = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")

    def odd(name: Column, content: Column) -> Column:
        return content.isNotNull() & (~F.array_contains(known, name) | F.array_contains(unread, name))

    rest = F.map_filter("_fields", odd)
    rescued = F.when(F.col("_fields").isNull(), F.to_json(F.create_map(F.lit(CORRUPT), F.col(value)))).when(F.size(rest) > 0, F.to_json(rest))
    own = [F.col("_row").getField(f.name).alias(f.name) for f in schema.fields]
    return read.select(*[F.col(c) for c in lines.columns], *own, rescued.alias(RESCUED))


def drift(df: DataFrame) -> DataFrame:
    """``field, rows``: what was rescued, over all rows; ``_corrupt_line`` counts lines that are no object."""
    names = F.map_keys(F.from_json(RESCUED, T.MapType(T.StringType(), T.StringType())))
    return df.select(F.explode(names).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("rows"))


def widened(spark: SparkSession, df: DataFrame, schema: T.StructType) -> T.StructType:
    """The schema with the rescued fields that it lacks, each of the type that fits all its values.

    Spark merges the types of all rows in one aggregate; fields of which only NULLs or several kinds came are text.
    """
    content = F.from_json(RESCUED, T.MapType(T.StringType(), T.StringType()))
    known = {f.name for f in schema.fields} | {CORRUPT}
    values = df.filter(F.col(RESCUED).isNotNull()).select(F.explode(content).alias("field", "value")).filter(~F.col("field").isin(*known))
    # A text value stands without its quotes here; what is no JSON by itself is text.
    typed = values.groupBy("field").agg(F.schema_of_variant_agg(F.coalesce(F.try_parse_json("value"), F.to_variant_object(F.array("value")))).alias("type"))
    found = sorted((r["field"], _column_type(r["type"])) for r in typed.collect())  # one row for each new field
    fields = [*schema.fields, *(T.StructField(name, spark.createDataFrame([], f"x {kind}").schema["x"].dataType) for name, kind in found)]
    return T.StructType(fields)


def _column_type(variant: str) -> str:
    """A column's type for what a variant's schema says."""
    plain = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", variant).replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    return "STRING" if "VARIANT" in plain or plain.startswith("ARRAY<STRING>") else plain
