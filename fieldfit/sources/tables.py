"""Warehouse table scans and chunk-file output."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.session import scratch_path

# Stored type -> types it is read as without loss.
WIDENED = {
    "byte": {"short", "integer", "long"},
    "short": {"integer", "long"},
    "integer": {"long"},
    "float": {"double"},
    "timestamp_ntz": {"timestamp"},
}
FILES_PER_TASK = 1000  # chunk files are numbered with three digits within a task


def _fits(stored: T.DataType, declared: T.DataType) -> bool:
    """Whether stored values are values of the declared type; decimals may have any precision."""
    if isinstance(stored, T.ArrayType) and isinstance(declared, T.ArrayType):
        return _fits(stored.elementType, declared.elementType)
    name, wanted = stored.typeName(), declared.typeName()
    return name == wanted or wanted in WIDENED.get(name, ())


def declared(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """The columns of ``schema``, in its types.

    A missing column or one whose stored type does not fit is an error that names
    the table, the column and both types; all faults are reported at once. Whole
    numbers, floats and local timestamps are widened, decimals keep their own
    precision, other columns are left out. Runs no job.
    """
    found = {f.name.lower(): f for f in df.schema.fields}
    faults, out = [], []
    for field in schema.fields:
        has = found.get(field.name.lower())
        if has is None:
            faults.append(f"column {field.name} is missing")
            continue
        if not _fits(has.dataType, field.dataType):
            faults.append(f"column {field.name} is {has.dataType.simpleString()}, not {field.dataType.simpleString()}")
        col = F.col(f"`{has.name}`")
        out.append((col if isinstance(field.dataType, T.DecimalType) else col.cast(field.dataType)).alias(field.name))
    if faults:
        raise TypeError(f"{name}: " + "; ".join(faults))
    return df.select(*out)


def load_table(
    spark: SparkSession,
    root: str | None,
    name: str,
    columns: dict[str, str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a table below ``root`` (or a catalog table), with column renames.

    ``columns`` maps this library's column name to the stored one, for
    warehouses that use other names; only these columns are then read.
    ``schema`` declares the columns under this library's names: only they are read,
    and a stored table that lacks one or has another type is refused (see
    ``declared``). JSON files hold no schema: they are parsed by the declared one, and
    a value of another type stops the job.
    """
    stored = {ours.lower(): theirs for ours, theirs in (columns or {}).items()}
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "json" and root is not None:
        fields = [T.StructField(stored.get(f.name.lower(), f.name), f.dataType) for f in schema.fields]
        reader = reader.schema(T.StructType(fields)).option("mode", "FAILFAST")
    df = spark.table(name) if root is None else reader.load(f"{root}/{name}")
    if columns:
        have = {c.lower() for c in df.columns}
        if schema is not None:  # a stored column that is not there is reported with the others
            columns = {ours: theirs for ours, theirs in columns.items() if theirs.lower() in have}
            same = {f.name: f.name for f in schema.fields if f.name.lower() not in stored and f.name.lower() in have}
            columns = {**same, **columns}
        df = df.select(*[F.col(theirs).alias(ours) for ours, theirs in columns.items()])
    elif schema is None:
        df = df.toDF(*[c.lower() for c in df.columns])
    return df if schema is None else declared(df, schema, name)


def write_chunks(
    df: DataFrame, path: str, keys: list[str], rows_per_file: int = 100, wrap: str | None = None
) -> None:
    """Files holding one JSON array each, ordered by key as their names are.

    Every file has ``rows_per_file`` rows but the very last one. Rows are ordered by
    key and then by all other columns, so equal keys may be split over files.

    Rows are range-partitioned and sorted once and stored with their place. The sizes
    of the ranges, summed up, give every row its number in the whole table; rows then
    go to the task of their file, a line each, and the writer starts a new file after
    ``rows_per_file`` lines. No array is gathered, so neither a hot key nor a large
    file size needs memory.
    ``wrap`` writes ``{wrap: [rows]}`` objects instead of bare arrays.
    """
    spark, size = df.sparkSession, int(rows_per_file)
    if size < 1:
        raise ValueError(f"rows_per_file must be at least 1, not {rows_per_file}")
    total_order = [f"`{c}`" for c in [*keys, *[c for c in df.columns if c not in keys]]]
    ordered = df.repartitionByRange(*total_order).sortWithinPartitions(*total_order)
    # The id counts up within a partition in its low 33 bits.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    scratch = scratch_path(spark, "ordered")
    ordered.select(F.spark_partition_id().alias("part"), place.alias("pos"), row.alias("row")).write.parquet(scratch)
    rows = spark.read.schema("part int, pos bigint, row string").parquet(scratch)
    # One number per range: as many as the range shuffle had partitions.
    ranges = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    firsts = ranges.select("part", (F.expr("sum(n) over (order by part)") - F.col("n")).alias("first"))
    total = rows.count()
    files = -(-total // size)
    tasks = max(1, min(files, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-files // FILES_PER_TASK))
    number = F.col("first") + F.col("pos")
    numbered = rows.join(F.broadcast(firsts), "part").select(number.alias("number"), "row")
    task = F.expr(f"cast(number div {size * -(-files // tasks) or 1} as int)")
    dealt = numbered.repartitionById(tasks, task).sortWithinPartitions("number")
    opening, closing = ("[", "]") if wrap is None else ("{" + f"{json.dumps(wrap)}:[", "]}")
    first = F.col("number") % size == 0
    last = (F.col("number") % size == size - 1) | (F.col("number") == total - 1)
    line = F.concat(F.when(first, F.lit(opening)).otherwise(F.lit(",")), "row", F.when(last, F.lit(closing)).otherwise(F.lit("")))
    dealt.select(line).write.option("maxRecordsPerFile", size).text(path)
