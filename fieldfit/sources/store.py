"""Snapshot tables: Parquet folders partitioned by a bucket of their keys."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldfit.operators.snapshots import ARRIVAL, patch, replace_by_key, upsert
from fieldfit.session import stored

BUCKET = "_bucket_"


class SnapshotStore:
    """Snapshot tables of one writer below a root folder.

    A table lies in partitions by the hash of its keys. ``merge``, ``replace`` and
    ``patch`` read only the partitions that the payload has keys of and write only
    those again, by Spark's dynamic partition overwrite: a payload of k keys touches
    at most k of ``buckets`` partitions. Written by other keys or another number of
    buckets, or as a whole, a table is laid out anew by the first such call.

    Spark puts the new files in place when all tasks have succeeded; until then the
    old ones stay. A payload applied again gives the same table. Frames from
    ``current`` are to be read before the next write.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _files(self, table: str) -> DataFrame | None:
        """The table with its partition column; a column that older files lack is NULL there."""
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(self._path(table))
        except AnalysisException as error:
            if (error.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def current(self, table: str) -> DataFrame | None:
        """The table's rows; None if there is no table, or an empty one."""
        df = self._files(table)
        return None if df is None else df.drop(*[c for c in df.columns if c.startswith(BUCKET)])

    def _bucket(self, keys: list[str]) -> tuple[str, Column]:
        """Name and value of the partition column; the name tells keys and number of buckets."""
        name = f"{BUCKET}{self.buckets}_{zlib.crc32(','.join(keys).encode()):08x}"
        return name, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def publish(self, df: DataFrame, table: str, keys: list[str] | None = None) -> None:
        """Replace the whole table; with ``keys`` in partitions of these.

        The rows are computed into the shared folder first, so ``df`` may read the
        table itself, and a failing query leaves it as it was.
        """
        df = stored(df, f"staged-{table}")
        writer = df.write
        if keys:
            name, value = self._bucket(keys)
            writer = df.withColumn(name, value).hint("rebalance", name).write.partitionBy(name)
        writer.mode("overwrite").parquet(self._path(table))

    def rewrite(self, table: str, keys: list[str], payload: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        """Apply ``change`` to the partitions that the keys of ``payload`` fall in.

        ``change`` must leave rows of other keys alone and at least one row of every
        touched partition.
        """
        name, value = self._bucket(keys)
        base = self._files(table)
        if base is None or name not in base.columns:
            whole = self.current(table)
            if whole is None:
                whole = payload.select(*[c for c in payload.columns if c not in ARRIVAL]).limit(0)
            return self.publish(change(whole), table, keys)
        # as many numbers as there are buckets at most
        touched = [r[0] for r in payload.select(value.alias(name)).distinct().collect()]
        if touched:
            changed = change(base.filter(F.col(name).isin(touched)).drop(name))
            writer = changed.withColumn(name, value).hint("rebalance", name).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(self._path(table))

    def merge(self, updates: DataFrame, table: str, keys: list[str]) -> None:
        """Upsert into the table (or into an empty one)."""
        self.rewrite(table, keys, updates, lambda base: upsert(base, updates, keys))

    def replace(self, rows: DataFrame, table: str, key: str) -> None:
        """Replace the rows of every key present in ``rows``."""
        self.rewrite(table, [key], rows, lambda base: replace_by_key(base, rows, key))

    def patch(self, updates: DataFrame, table: str, key: str, cols: list[str], skip: str = "null") -> None:
        """Update matched rows only; no table, no rows."""
        if self._files(table) is not None:
            self.rewrite(table, [key], updates, lambda base: patch(base, updates, key, cols, skip))
