"""Arriving chunk files merged into a snapshot."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from fieldfit.session import stored
from fieldfit.sources.payload import read_chunk_files
from fieldfit.sources.store import SnapshotStore


def stream_upsert(
    spark: SparkSession,
    folder: str,
    store: SnapshotStore,
    table: str,
    schema: T.StructType,
    keys: list[str],
    checkpoint: str,
    trigger: dict | None = None,
):
    """Start a query that upserts every new ``<table>-*.json`` file's rows.

    An upsert applied again changes nothing, so a micro-batch repeated after a
    failure needs no record of its own, and several streams, or one with a new
    checkpoint, may follow each other into one table. A field that ``schema`` does
    not know stops the stream. The default trigger handles all files present and
    stops.
    """
    rows = read_chunk_files(spark.readStream, folder, table, schema, unknown="raise")

    def apply(batch, batch_id: int) -> None:
        store.merge(stored(batch, f"batch-{table}"), table, keys)

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
