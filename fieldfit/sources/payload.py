"""Sync payloads: bundle objects and chunk files, per table."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sort order of the payload parts: every bundle before every chunk file.
BUNDLE, CHUNK = "0:", "1:"
STRICT = {"mode": "FAILFAST"}


def _arrival(part: str):
    return F.concat(F.lit(part), F.col("_metadata.file_path")).alias("arrival_file")


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema).select(
        "*",
        F.lit("").alias("arrival_file"),
        F.lit(0).cast("bigint").alias("arrival_pos"),
        F.lit(None).cast("array<string>").alias("arrival_keys"),
    )


def _missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def _found(each: DataFrame, schema: T.StructType) -> T.StructType:
    """``schema`` and the fields that the objects carry beyond it, with the types of their values.

    Spark's variant type gives one schema for all objects, merged in the tasks. Whole
    numbers are long, others double; where objects disagree, and where all values
    are null, the field is text.
    """
    merged = each.agg(F.schema_of_variant_agg(F.parse_json("item"))).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        return schema
    merged = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", merged.replace("OBJECT<", "STRUCT<"))
    merged = T.DataType.fromDDL(re.sub(r"\b(VOID|VARIANT)\b(?=[,>])", "STRING", merged))
    known = {name.lower() for name in schema.names}
    return T.StructType([*schema.fields, *[f for f in merged.fields if f.name.lower() not in known]])


def _parsed(files: DataFrame, items, schema: T.StructType, unknown: str) -> DataFrame:
    """Rows of JSON objects: typed columns, file, position in it, and the keys each object carries.

    A damaged file or a value of another type stops the job; nothing may be taken
    for missing that could not be read. Fields that ``schema`` does not know become
    columns (``unknown="add"``, which reads the files once more), stop the job
    (``"raise"``) or are left out (``"drop"``).
    """
    if unknown not in ("add", "raise", "drop"):
        raise ValueError(f"unknown must be add, raise or drop, not {unknown!r}")
    each = files.select("arrival_file", F.posexplode(items).alias("pos", "item")).filter("item is not null")
    if unknown == "add":
        schema = _found(each, schema)
    if unknown == "raise":
        beyond = F.array_except(F.json_object_keys("item"), F.array(*map(F.lit, schema.names)))
        said = F.raise_error(F.concat(F.lit("fields no schema knows: "), F.array_join(beyond, ", "))).cast("string")
        each = each.withColumn("item", F.when(F.size(beyond) > 0, said).otherwise(F.col("item")))
    return each.select(
        F.from_json("item", schema, STRICT).alias("row"),
        "arrival_file",
        F.col("pos").cast("bigint").alias("arrival_pos"),
        F.json_object_keys("item").alias("arrival_keys"),
    ).select("row.*", "arrival_file", "arrival_pos", "arrival_keys")


def load_bundle(spark: SparkSession, path: str, table: str, schema: T.StructType, unknown: str = "add") -> DataFrame:
    """One table of bundle objects ``{table: [rows]}``; missing key or file = empty.

    Only the wanted key is parsed. A bundle is one JSON document and therefore
    read by one task; large payloads come as chunk files or several bundles.
    """
    outer = T.StructType([T.StructField(table, T.ArrayType(T.StringType()))])
    try:
        bundle = spark.read.text(path, wholetext=True).select("value", _arrival(BUNDLE))
    except AnalysisException as error:
        if _missing(error):
            return _empty(spark, schema)
        raise
    return _parsed(bundle, F.from_json("value", outer, STRICT).getField(table), schema, unknown)


def read_chunk_files(reader, folder: str, table: str, schema: T.StructType, unknown: str = "add") -> DataFrame:
    """Rows of all ``<table>-*.json`` array files (batch or stream reader)."""
    files = reader.text(f"{folder}/{table}-*.json", wholetext=True).select("value", _arrival(CHUNK))
    return _parsed(files, F.from_json("value", T.ArrayType(T.StringType()), STRICT), schema, unknown)


def load_chunks(spark: SparkSession, folder: str, table: str, schema: T.StructType, unknown: str = "add") -> DataFrame:
    """All ``<table>-*.json`` array files of a folder, with arrival order."""
    try:
        return read_chunk_files(spark.read, folder, table, schema, unknown)
    except AnalysisException as error:
        if _missing(error):
            return _empty(spark, schema)
        raise


def load_payload(
    spark: SparkSession, bundle: str, folder: str, table: str, schema: T.StructType, unknown: str = "add"
) -> DataFrame:
    """Bundle rows, then chunk rows in file order.

    ``arrival_keys`` says per row which columns its object carried, so that a
    column one file lacks does not speak for another file's rows. A field that only
    some files carry is NULL in the rows of the others.
    """
    first, then = load_bundle(spark, bundle, table, schema, unknown), load_chunks(spark, folder, table, schema, unknown)
    both = {f.name: f.dataType for f in first.schema.fields}
    for f in then.schema.fields:
        if both.get(f.name, f.dataType) != f.dataType:  # an unknown field, found with another type
            kind = "double" if {both[f.name].typeName(), f.dataType.typeName()} == {"long", "double"} else "string"
            first, then = (d.withColumn(f.name, F.col(f.name).cast(kind)) for d in (first, then))
    return first.unionByName(then, allowMissingColumns=True)
