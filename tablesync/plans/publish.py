"""Atomic publish on plain parquet: generations of key buckets.

A table is a set of bucket folders ``<root>/<table>/__gen=<run>/__bucket=<b>``;
a row's bucket is a hash of its key.  One pointer row names the folders that
are the current table:

* a full refresh writes every bucket anew;
* a delta reads only the buckets that hold its keys, takes their rows with a
  staged key out, adds the staged rows and writes those buckets into a new
  generation (``operators.upsert.delta_upsert`` within the buckets).  The
  folders of all other buckets stay as they are and go on being named.

Visibility is atomic: data is written first, its observed row count checked,
and only then is one row appended to the ``_generations`` pointer table.
Readers see the previous or the new state, never a partial one; a failure
before that leaves an orphan folder and the old state.  Folders no recent
pointer row names are found by ``superseded`` and deleted by ``vacuum``.

Rows without a key match nothing: they lie in any bucket (spread by a hash of
their values), and a delta puts its own into the buckets it rewrites anyway.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import upsert
from tablesync.session import delete_path, list_names, path_exists

POINTER_SCHEMA = ("table string, run_id string, seq long, rows long, pk string, buckets int, "
                  "folders string, schema string")
_POINTER_NAMES = ["table", "run_id", "seq", "rows", "pk", "buckets", "folders", "schema"]
BUCKET, GENERATION = "__bucket", "__gen"
ROWS_PER_BUCKET = 10_000_000
MIN_BUCKETS, MAX_BUCKETS = 8, 65_536   # the pointer row names each bucket's folder


class VerificationError(RuntimeError):
    pass


@dataclass(frozen=True)
class Written:
    """A generation on disk that nothing names yet."""
    table: str
    run_id: str
    path: str                 # the folder this run wrote
    written: int              # rows in it
    loaded: int               # of which the run's own
    rows: int                 # of the table, once named
    pk: list[str] | None
    buckets: int
    folders: dict[str, str]   # bucket -> folder, for the whole table
    schema: str

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Written:
        return Written(**json.loads(text))


def _keys(pk: str | Sequence[str] | None) -> list[str] | None:
    return None if pk is None else [pk] if isinstance(pk, str) else list(pk)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hash(df: DataFrame, names: Sequence[str]) -> Column:
    """A hash that equal values share: -0.0 is 0.0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.xxhash64(*[_quoted(n) + F.lit(0.0) if isinstance(types[n], (T.FloatType, T.DoubleType)) else _quoted(n)
                        for n in names])


def _spread(df: DataFrame) -> Column:
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return _hash(df, names) if names else F.lit(0).cast("long")


def bucket_of(df: DataFrame, pk: Sequence[str] | None, buckets: int, homeless: Sequence[int] | None = None) -> Column:
    """A row's bucket: by its key, or without one by a hash of all its values
    (over ``homeless`` buckets, where given)."""
    if homeless:
        other = F.get(F.array(*[F.lit(int(b)) for b in homeless]), F.pmod(_spread(df), F.lit(len(homeless))).cast("int"))
    else:
        other = F.pmod(_spread(df), F.lit(buckets)).cast("int")
    if not pk:
        return other
    has_key = reduce(lambda a, b: a & b, [_quoted(k).isNotNull() for k in pk])
    return F.when(has_key, F.pmod(_hash(df, pk), F.lit(buckets)).cast("int")).otherwise(other)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class TableStore:
    """Published tables under one shared root folder."""

    def __init__(self, spark: SparkSession, root: str, view_prefix: str = "",
                 rows_per_bucket: int = ROWS_PER_BUCKET, min_buckets: int = MIN_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.view_prefix = view_prefix  # of the session views of the tables
        self.rows_per_bucket = rows_per_bucket
        self.min_buckets = min_buckets
        # Pointer state of tables this store has read or written.  A table has
        # one writer (its sync job or stream), which keeps this cache exact;
        # ``state(refresh=True)`` re-reads the pointer table.
        self._cache: dict[str, dict | None] = {}

    @property
    def pointer_path(self) -> str:
        return f"{self.root}/_generations"

    def buckets_for(self, rows: int) -> int:
        return min(MAX_BUCKETS, max(self.min_buckets, -(-int(rows) // self.rows_per_bucket)))

    # ------------------------------------------------------------- reading
    def _pointers(self) -> DataFrame | None:
        if not path_exists(self.pointer_path, self.spark):
            return None  # nothing published yet
        return self.spark.read.schema(POINTER_SCHEMA).parquet(self.pointer_path)

    def state(self, table: str, refresh: bool = False) -> dict | None:
        """The pointer row of the current table, or None before the first
        publish: one row, whatever the history."""
        if refresh or table not in self._cache:
            ptr = self._pointers()
            last = None if ptr is None else (
                ptr.where(F.col("table") == table).agg(F.max_by(F.struct(*_POINTER_NAMES), "seq").alias("p")).first())
            entry = None if last is None or last["p"] is None else last["p"].asDict()
            if entry is not None:
                entry["pk"] = json.loads(entry["pk"]) if entry["pk"] else None
                entry["folders"] = json.loads(entry["folders"])
            self._cache[table] = entry
        return self._cache[table]

    def _read(self, table: str, schema: str, folders: dict[str, str]) -> DataFrame:
        """Rows of some buckets, with their bucket."""
        fields = T.StructType.fromJson(json.loads(schema))
        fields = T.StructType([*fields.fields, T.StructField(BUCKET, T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], fields)
        base = f"{self.root}/{table}"
        paths = [f"{base}/{folder}" for folder in folders.values()]
        return (self.spark.read.schema(fields).option("basePath", base).parquet(*paths)
                .select(*[_quoted(f.name) for f in fields.fields]))

    def current(self, table: str) -> DataFrame | None:
        """The current table, or None before the first publish."""
        entry = self.state(table)
        return None if entry is None else self._read(table, entry["schema"], entry["folders"]).drop(BUCKET)

    def published(self, table: str, run_id: str) -> bool:
        """Whether some pointer row of ``table`` carries ``run_id``."""
        ptr = self._pointers()
        return ptr is not None and bool(
            ptr.where((F.col("table") == table) & (F.col("run_id") == run_id)).limit(1).count())

    # ------------------------------------------------------------- writing
    def _write(self, table: str, run_id: str, rows: DataFrame) -> tuple[str, dict[str, str], int, int]:
        """Write rows by ``BUCKET``; ``__own`` marks the run's.  ``(path,
        folders, rows, own rows)``, counted by the write itself."""
        gen = f"{GENERATION}={run_id.replace('/', '_').replace(':', '_')}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{gen}"
        obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
        (rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(F.col("__own").cast("long")).alias("own"))
         .drop("__own").write.mode("errorifexists").partitionBy(BUCKET).parquet(path))
        got = obs.get
        # At most one folder a bucket.
        folders = {n.split("=", 1)[1]: f"{gen}/{n}" for n in list_names(path, self.spark) if n.startswith(f"{BUCKET}=")}
        return path, folders, int(got["rows"]), int(got["own"] or 0)

    def write_full(self, table: str, df: DataFrame, run_id: str, pk=None, rows: int | None = None) -> Written:
        """Write all buckets of a new table (not yet visible).  ``rows`` sizes
        the buckets; it is counted where the caller does not know it."""
        keys = _keys(pk)
        if keys and any(k not in df.columns for k in keys):
            keys = None
        n = self.buckets_for(df.count() if rows is None else rows)
        placed = df.select("*", bucket_of(df, keys, n).alias(BUCKET), F.lit(True).alias("__own"))
        # One task or a few per bucket; an outsize one is split at runtime.
        path, folders, written, own = self._write(table, run_id, placed.hint("rebalance", F.col(BUCKET)))
        return Written(table, str(run_id), path, written, own, written, keys, n, folders, _nullable(df.schema).json())

    def write_delta(self, table: str, staged: DataFrame, pk, run_id: str, staged_rows: int | None = None,
                    staged_key_bytes: int | None = None) -> Written:
        """Rewrite the buckets that hold a key of ``staged`` (not yet visible);
        the first delta writes them all."""
        entry = self.state(table)
        if entry is None:
            return self.write_full(table, staged, run_id, pk, staged_rows)
        keys = _keys(pk)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        for what, names in (("staged rows", staged.columns), ("published table", schema.names)):
            lost = [k for k in keys if k not in names]
            if lost:
                raise VerificationError(f"key columns {lost} are not in the {what} of {table}")
        if staged_rows is None:
            staged_rows, staged_key_bytes = upsert.measure_keys(staged, keys)
        empty = self.spark.createDataFrame([], schema)
        aligned = upsert.align_staged(staged, upsert.evolve_target(empty, staged))
        n, same_key = entry["buckets"], entry["pk"] == keys
        held = sorted(int(b) for b in entry["folders"])
        touched = held
        if same_key:
            has_key = reduce(lambda a, b: a & b, [_quoted(k).isNotNull() for k in keys])
            # At most one row a bucket.
            touched = sorted(r[0] for r in aligned.where(has_key).select(
                bucket_of(aligned, keys, n).alias("b")).distinct().collect())
            touched = touched or held[:1] or [0]  # only rows without a key: one bucket takes them
        if not same_key or len(touched) == n:
            touched, n = held, max(n, self.buckets_for(entry["rows"] + staged_rows))
            homeless = None
        else:
            homeless = touched
        read = {str(b): entry["folders"][str(b)] for b in touched if str(b) in entry["folders"]}
        old = self._read(table, entry["schema"], read)
        if n != entry["buckets"] or not same_key:
            old = old.drop(BUCKET)
            old = old.select("*", bucket_of(old, keys, n).alias(BUCKET))
        new = aligned.select("*", bucket_of(aligned, keys, n, homeless).alias(BUCKET), F.lit(True).alias("__own"))
        small = upsert.broadcast_ok(staged, keys, staged_rows, staged_key_bytes,
                                    upsert.DEFAULT_BROADCAST_KEY_ROWS, upsert.DEFAULT_BROADCAST_KEY_BYTES)
        if small and same_key and n == entry["buckets"]:
            new = new.hint("rebalance", F.col(BUCKET))  # the old rows are in bucket order already
        rows = upsert.delta_upsert(old.select("*", F.lit(False).alias("__own")), new, keys, staged_rows=staged_rows,
                                   staged_key_bytes=staged_key_bytes)
        if not (small and same_key and n == entry["buckets"]):
            rows = rows.hint("rebalance", F.col(BUCKET))
        before = self._rows(table, read)
        path, folders, written, own = self._write(table, run_id, rows)
        kept = {b: f for b, f in entry["folders"].items() if b not in read}
        return Written(table, str(run_id), path, written, own, entry["rows"] - before + written, keys, n,
                       {**kept, **folders}, _nullable(aligned.schema).json())

    def _rows(self, table: str, folders: dict[str, str]) -> int:
        """Rows of some buckets, from parquet metadata."""
        paths = [f"{self.root}/{table}/{f}" for f in folders.values()]
        return self.spark.read.schema("_none int").parquet(*paths).count() if paths else 0

    def swap(self, written: Written) -> None:
        """Make a written generation current: one appended row."""
        row = (written.table, written.run_id, time.time_ns(), written.rows,
               json.dumps(written.pk) if written.pk else None, written.buckets, json.dumps(written.folders),
               written.schema)
        # Partitioned by table: a reader of one table prunes to its own files.
        (self.spark.createDataFrame([row], POINTER_SCHEMA).coalesce(1).write.mode("append")
         .partitionBy("table").parquet(self.pointer_path))
        entry = dict(zip(_POINTER_NAMES, row))
        self._cache[written.table] = {**entry, "pk": written.pk, "folders": written.folders}
        self.refresh_view(written.table)

    def _checked_swap(self, written: Written, expected: int | None) -> Written:
        if expected is not None and written.loaded != expected:
            raise VerificationError(f"count mismatch: {expected} expected, {written.loaded} written")
        self.swap(written)
        return written

    def publish(self, table: str, df: DataFrame, run_id: str, expected: int | None = None, pk=None,
                rows: int | None = None) -> Written:
        """Full refresh: replace the table with ``df``."""
        return self._checked_swap(self.write_full(table, df, run_id, pk, rows), expected)

    def publish_delta(self, table: str, staged: DataFrame, pk, run_id: str, expected: int | None = None,
                      staged_rows: int | None = None, staged_key_bytes: int | None = None) -> Written:
        """Keyed delta: the first run creates the table, later ones rewrite the
        buckets they touch."""
        return self._checked_swap(
            self.write_delta(table, staged, pk, run_id, staged_rows, staged_key_bytes), expected)

    # --------------------------------------------------------- housekeeping
    def refresh_view(self, table: str) -> None:
        df = self.current(table)
        if df is not None:
            df.createOrReplaceTempView(self.view_prefix + table)

    def restore_views(self) -> None:
        """Re-create session views from the pointer table (new session)."""
        ptr = self._pointers()
        if ptr is None:
            return
        for row in ptr.select("table").distinct().collect():
            self.refresh_view(row["table"])

    def superseded(self, table: str, keep: int = 2) -> list[str]:
        """Bucket folders of generations on disk that none of the last ``keep``
        pointer rows names: replaced ones, and orphans of failed runs that
        began before the last publish."""
        ptr = self._pointers()
        if ptr is None or keep < 1:
            return []
        last = [r.asDict() for r in ptr.where(F.col("table") == table).orderBy(F.col("seq").desc()).limit(keep).collect()]
        if not last:
            return []
        live = {f for r in last for f in json.loads(r["folders"]).values()}
        newest = last[0]["seq"] // 1_000_000
        out = []
        for gen in list_names(f"{self.root}/{table}", self.spark, before_ms=newest):
            if gen.startswith(f"{GENERATION}="):
                names = [f"{gen}/{b}" for b in list_names(f"{self.root}/{table}/{gen}", self.spark)
                         if b.startswith(f"{BUCKET}=")]
                gone = [f for f in names if f not in live]
                # A generation of which nothing is named goes whole.
                out += [gen] if len(gone) == len(names) else gone
        return sorted(out)

    def vacuum(self, table: str, keep: int = 2) -> list[str]:
        """Delete what ``superseded`` finds, and trim the pointer rows to the
        last ``keep`` and each stream's last batch (the one it may replay);
        readers of the last ``keep`` states are not disturbed."""
        gone = self.superseded(table, keep)
        for folder in gone:
            delete_path(f"{self.root}/{table}/{folder}", self.spark)
        ptr = self._pointers()
        if ptr is not None and keep >= 1:
            mine = ptr.where(F.col("table") == table)
            last = mine.orderBy(F.col("seq").desc()).limit(keep)
            stream = F.substring_index("run_id", ":", 1)
            batches = (mine.where(F.col("run_id").contains(":")).groupBy(stream)
                       .agg(F.max_by(F.struct(*_POINTER_NAMES), "seq").alias("p")).select("p.*"))
            # One table's partition is replaced in one commit.
            (last.select(*_POINTER_NAMES).unionByName(batches).dropDuplicates(["run_id", "seq"]).coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("table").parquet(self.pointer_path))
        return gone
