from fieldfit.streaming.upserts import stream_upsert

__all__ = ["stream_upsert"]
