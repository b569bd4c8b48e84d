"""One synchronisation: every payload table merged into its snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.operators.snapshots import ARRIVAL, patch, remove_stale, replace_by_key, stamp, upsert
from fieldfit.schemas import PAYLOAD, SNAPSHOTS
from fieldfit.session import stored
from fieldfit.sources import SnapshotStore, load_payload

# Payload key -> (snapshot table, key columns) of the plain upserts.
UPSERTS = {
    "basic_value": ("basic_value_snapshot", ["company_id"]),
    "field_status": ("field_status_snapshot", ["ordem_servico_raw"]),
    "completude_instalacao": ("completude_instalacao_snapshot", ["deal_id"]),
    "esn_validacao": ("esn_validacao_snapshot", ["ticket_id", "esn"]),
}


def snapshot(spark: SparkSession, store: SnapshotStore, table: str) -> DataFrame:
    """Rows of a snapshot table, or an empty one."""
    current = store.current(table)
    return spark.createDataFrame([], SNAPSHOTS[table]) if current is None else current


def with_columns(base: DataFrame, schema: T.StructType) -> DataFrame:
    """``base`` with the columns of ``schema`` that it lacks, as NULL."""
    lacking = [f for f in schema.fields if f.name not in base.columns]
    return base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}) if lacking else base


def merged_tickets(base: DataFrame, tickets: DataFrame, deal_ids: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Tickets upserted, those gone from a full payload removed, deals filled in."""
    merged = stamp(upsert(base, tickets, ["ticket_id"]), as_of)
    kept = remove_stale(merged, tickets, "ticket_id")
    return patch(kept, deal_ids, "ticket_id", ["deal_id"], skip="falsy")


def apply_payload(
    spark: SparkSession, store: SnapshotStore, bundle: str, folder: str, as_of: dt.datetime, unknown: str = "add"
) -> set[str]:
    """Merge bundle and chunk files into the store; the names of the tables written.

    Every file is parsed into the shared folder before anything is written: a damaged
    one stops the run with the store untouched. A table without payload rows is left
    as it is. A payload field that no schema knows becomes a column of the snapshot
    (``unknown="raise"`` stops the run instead); rows that lack it hold NULL.

    Only the partitions that the payload has keys of are read and written, but for
    tickets, where a full payload removes those that it lacks.
    """
    payload = {key: stored(load_payload(spark, bundle, folder, key, PAYLOAD[key], unknown), f"payload-{key}") for key in PAYLOAD}
    filled = {key for key, rows in payload.items() if not rows.isEmpty()}
    written = set()
    if filled & {"tickets", "ticket_deal_ids"}:
        base = snapshot(spark, store, "tickets_sync")
        store.publish(merged_tickets(base, payload["tickets"], payload["ticket_deal_ids"], as_of), "tickets_sync", ["ticket_id"])
        written.add("tickets_sync")
    for key, (table, keys) in UPSERTS.items():
        if key in filled:
            rows, declared = payload[key], SNAPSHOTS[table]
            store.rewrite(table, keys, rows, lambda base: stamp(upsert(with_columns(base, declared), rows, keys), as_of))
            written.add(table)
    if "ticket_products" in filled:
        rows = payload["ticket_products"].drop(*ARRIVAL)
        store.rewrite("ticket_products", ["ticket_id"], rows, lambda base: replace_by_key(with_columns(base, rows.schema), rows, "ticket_id"))
        written.add("ticket_products")
    if "team_members_updates" in filled:
        store.patch(payload["team_members_updates"], "team_members", "email", ["hubspot_owner_id"])
        written.add("team_members")
    return written
