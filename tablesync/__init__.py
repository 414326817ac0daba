"""tablesync: a Spark-native table synchronisation library.

Paged or file sources are scanned as DataFrames, every row is cleaned with
built-in column expressions, checked against declarative contracts (rejects go
to a dead-letter table), and published by full refresh or keyed delta upsert
with schema evolution, an incremental cursor, count verification and an atomic
generation swap.  Run history, checkpoints, cursors and dead letters are plain
append-only tables queried with DataFrames.
"""

from tablesync.functions.clean import redact, sanitize
from tablesync.functions.types import narrow_types
from tablesync.operators.contracts import Field, validate
from tablesync.operators.upsert import delta_upsert, full_refresh
from tablesync.plans.job import StateStore, SyncSpec, sync_all, sync_table
from tablesync.plans.publish import TableStore
from tablesync.session import get_session, scratch_dir

__all__ = [
    "Field", "StateStore", "SyncSpec", "TableStore", "delta_upsert", "full_refresh", "get_session",
    "narrow_types", "redact", "sanitize", "scratch_dir", "sync_all", "sync_table", "validate",
]
