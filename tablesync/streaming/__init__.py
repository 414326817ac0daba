from tablesync.streaming.upsert_stream import make_batch_upsert, run_stream_upsert, start_stream_upsert

__all__ = ["make_batch_upsert", "run_stream_upsert", "start_stream_upsert"]
