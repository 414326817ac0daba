from tablesync.operators.upsert import delta_upsert, full_refresh

__all__ = ["delta_upsert", "full_refresh"]
