from fieldfit.sources.bucketed import write_bucketed
from fieldfit.sources.payload import load_bundle, load_chunks, load_payload
from fieldfit.sources.store import SnapshotStore
from fieldfit.sources.tables import declared, load_table, write_chunks

__all__ = [
    "SnapshotStore",
    "declared",
    "load_bundle",
    "load_chunks",
    "load_payload",
    "load_table",
    "write_bucketed",
    "write_chunks",
]
