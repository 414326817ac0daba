"""Full refresh and keyed delta upsert (delete-by-key, then insert by name).

Semantics kept from the original loader:

* every target row whose key equals a staged key is removed, then ALL staged
  rows are inserted -- duplicate keys inside staging are all kept;
* a NULL key never matches: target NULL-key rows stay, staged ones are added;
* staged columns missing from the target are added (staging order) with the
  mapped type of ``functions.types.added_column_type``; old rows get NULL;
* target-only columns are NULL for the inserted rows.

Plan shape: ``target LEFT ANTI JOIN staged_keys`` then ``UNION ALL staged``.
With a proven bound on the staged keys (observed rows and key bytes) the key
side is broadcast, so the (large) target is never shuffled.  Otherwise the
key side is de-duplicated with a partial aggregate (a hot staged key collapses
map-side) and the join is salted: target rows of one key -- a hot key, or the
NULL keys -- are spread over ``salt_buckets`` partitions, the key side is
replicated per salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.types import added_column_type, to_added_type

# A staged key set is broadcast only under BOTH bounds: its observed row
# count and its key bytes (observed, or rows x width for fixed-width keys).
DEFAULT_BROADCAST_KEY_ROWS = 20_000_000
DEFAULT_BROADCAST_KEY_BYTES = 256 * 1024 * 1024
# Shuffled path: target rows are spread over this many salts per key.
DEFAULT_SALT_BUCKETS = 16


# Bytes per value of fixed-width key types (upper bounds).
_FIXED_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
                T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
                T.BooleanType: 1, T.DecimalType: 16}


def _q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def evolve_target(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Target with the staged-only columns appended as typed NULLs."""
    added = [f for f in staged.schema.fields if f.name not in target.columns]
    return target.select(
        *[F.col(_q(c)) for c in target.columns],
        *[F.lit(None).cast(added_column_type(f.dataType)).alias(f.name) for f in added],
    )


def align_staged(staged: DataFrame, evolved_target: DataFrame) -> DataFrame:
    """Staged rows shaped like the evolved target: existing columns cast to the
    target type (a bad value fails the run, as the database would), new
    columns converted to their added type, target-only columns NULL."""
    s_types = {f.name: f.dataType for f in staged.schema.fields}
    cols = []
    for f in evolved_target.schema.fields:
        if f.name not in s_types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif s_types[f.name] == f.dataType:
            cols.append(F.col(_q(f.name)))
        elif added_column_type(s_types[f.name]) == f.dataType:
            cols.append(to_added_type(F.col(_q(f.name)), s_types[f.name]).alias(f.name))
        else:
            cols.append(F.col(_q(f.name)).cast(f.dataType).alias(f.name))
    return staged.select(*cols)


def full_refresh(staged: DataFrame) -> DataFrame:
    """Full mode: the new table is exactly the staged rows (schema replaced)."""
    return staged


def key_bytes(pk: str | Sequence[str]):
    """Aggregate for an ``Observation``: bytes of the key values as text."""
    keys = [pk] if isinstance(pk, str) else list(pk)
    total = None
    for k in keys:
        b = F.coalesce(F.octet_length(F.col(f"`{k}`").cast("string")), F.lit(0))
        total = b if total is None else total + b
    return F.sum(total).cast("long")


def measure_keys(staged: DataFrame, pk: str | Sequence[str]) -> tuple[int, int]:
    """(rows, key bytes) of a staged set in one aggregate job -- the figures the
    sync job gets for free from its staging-write ``Observation``."""
    row = staged.agg(F.count(F.lit(1)).alias("n"), key_bytes(pk).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def broadcast_ok(staged: DataFrame, keys: Sequence[str], staged_rows: int | None,
                 staged_key_bytes: int | None, max_rows: int, max_bytes: int) -> bool:
    """True only when the key side's size is bounded by observed figures."""
    if staged_rows is None or staged_rows > max_rows:
        return False
    if staged_key_bytes is not None:
        return staged_key_bytes + 16 * staged_rows <= max_bytes
    types = {f.name: f.dataType for f in staged.schema.fields}
    widths = [_FIXED_WIDTH.get(type(types[k])) for k in keys]
    if any(w is None for w in widths):
        return False  # variable-width key without a measured size: no proven bound
    return staged_rows * (sum(widths) + 16) <= max_bytes


def delta_upsert(target: DataFrame | None, staged: DataFrame, pk: str | Sequence[str],
                 staged_rows: int | None = None, staged_key_bytes: int | None = None,
                 broadcast_key_rows: int = DEFAULT_BROADCAST_KEY_ROWS,
                 broadcast_key_bytes: int = DEFAULT_BROADCAST_KEY_BYTES,
                 salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Delete target rows whose key is staged, then insert all staged rows.

    ``target=None`` is the first delta run: the staged rows become the table.
    ``staged_rows`` / ``staged_key_bytes`` are observed on the staging write;
    when they bound the key set under both limits the key side is broadcast.
    """
    if target is None:
        return staged
    keys = [pk] if isinstance(pk, str) else list(pk)
    evolved = evolve_target(target, staged)
    inserted = align_staged(staged, evolved)

    key_cols = [F.col(_q(k)) for k in keys]
    not_null = key_cols[0].isNotNull()
    for c in key_cols[1:]:
        not_null = not_null & c.isNotNull()
    # Cast staged keys to the target key type so the equi-join compares like types.
    t_types = {f.name: f.dataType for f in evolved.schema.fields}
    staged_keys = staged.where(not_null).select(
        *[F.col(_q(k)).cast(t_types[k]).alias(k) for k in keys])
    if broadcast_ok(staged, keys, staged_rows, staged_key_bytes, broadcast_key_rows, broadcast_key_bytes):
        kept = evolved.join(F.broadcast(staged_keys), on=keys, how="left_anti")
    else:
        kept = salted_anti_join(evolved, staged_keys, keys, salt_buckets)
    return kept.unionByName(inserted)


def salted_anti_join(target: DataFrame, keys_df: DataFrame, keys: Sequence[str],
                     salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """``target LEFT ANTI JOIN keys_df`` (keys may repeat) with the target
    spread over salts.

    Each target row gets a deterministic salt (hash of its atomic columns mod
    ``salt_buckets``), so one hot key -- or all NULL keys, which never match --
    lands in ``salt_buckets`` shuffle partitions instead of one.  The
    de-duplicated key side is replicated once per salt: ``salt_buckets`` x the
    staged key set, small next to the target it spares from a one-task group.
    """
    if salt_buckets <= 1:
        return target.join(keys_df.distinct(), on=list(keys), how="left_anti")
    hashable = [F.col(_q(f.name)) for f in target.schema.fields
                if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(salt_buckets)).cast("int")
    # Explode first, then de-duplicate on (key, salt): the partial aggregate
    # collapses repeated keys map-side and its shuffle is the one the join uses.
    salted_keys = keys_df.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))).distinct()
    return (target.withColumn("_salt", salt)
            .join(salted_keys, on=[*keys, "_salt"], how="left_anti")
            .drop("_salt"))
