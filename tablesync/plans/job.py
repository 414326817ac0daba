"""The sync job: one table end to end as a chain of Spark actions.

    land (raw -> cleaned, staged parquet; count + cursor observed in the same pass)
    -> validate (one pass writes valid rows and dead letters, split by a flag)
    -> load (write a generation of the key buckets touched, counts observed)
    -> verify counts BEFORE the swap -> swap -> save cursor -> finish run
    -> drop the run's staged files.

Each stage appends a checkpoint row; a resumed run (``from_checkpoint``)
continues after the last completed stage of the unfinished run, reusing its
staged parquet -- the restart point after any failure.  A completed run always
starts fresh.  Counts of skipped stages are recomputed from the staged files.
Stage order follows the original tool: EXTRACT, VALIDATE, LOAD, VERIFY.

Driver work is bookkeeping only: one-row appends to the ledger tables and a
handful of scalar results from ``Observation``s or one-row aggregates.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.clean import sanitize, strip_nul_all
from tablesync.functions.redact_text import redact_text
from tablesync.functions.types import apply_narrowing, narrow_metrics, narrow_plan, plan_from_metrics, type_at
from tablesync.operators import contracts as ct
from tablesync.operators.cursor import cursor_candidate, delta_filter, is_number
from tablesync.operators.upsert import key_bytes
from tablesync.session import delete_path, path_exists
from tablesync.sources.files import staged_scan, write_staged
from tablesync.plans.publish import TableStore, VerificationError, Written
from tablesync.plans.snapshot import Ledger

STAGES = ["EXTRACT", "VALIDATE", "LOAD", "VERIFY"]

# One append-only ledger table holds runs, stage events, checkpoints and
# cursors (``kind``), partitioned by kind so each reader prunes to its rows.
LEDGER_FIELDS = [
    ("kind", "string"), ("run_id", "string"), ("client", "string"), ("pipeline", "string"),
    ("status", "string"), ("stage", "string"), ("event_type", "string"), ("data_path", "string"),
    ("value", "string"), ("records_in", "long"), ("records_out", "long"), ("records", "long"),
    ("error", "string"), ("started_at", "timestamp"), ("finished_at", "timestamp"),
    ("created_at", "timestamp"), ("seq", "long"), ("cleared", "boolean"),
]
LEDGER_SCHEMA = ", ".join(f"{n} {t}" for n, t in LEDGER_FIELDS)
_LEDGER_NAMES = [n for n, _ in LEDGER_FIELDS]


@dataclass(frozen=True)
class SyncSpec:
    """One table to synchronise."""
    name: str
    pk: str | tuple[str, ...] = "id"
    replication_key: str | None = None
    mode: str = "full"                    # full | incremental
    fields: tuple[str, ...] | None = None  # projection (ignored when transform_sql is set)
    transform_sql: str | None = None       # SQL with a {raw} placeholder
    contract: list | None = None           # list[contracts.Field]
    dedupe: bool = False                   # keep only the latest row per key inside a batch
    narrow: bool = True                    # type all-date / all-timestamp text columns
    numeric_cursor: bool = False           # compare a text key as a number (number columns always do)


@dataclass
class SyncResult:
    stream: str
    records_extracted: int
    records_loaded: int
    status: str
    error: str | None = None
    run_id: str | None = None
    counts: dict = field(default_factory=dict)


def apply_transform(spark: SparkSession, df: DataFrame, sql: str) -> DataFrame:
    """Run user SQL over ``df``, which the SQL names as ``{raw}``."""
    view = f"raw_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return spark.sql(sql.replace("{raw}", f"`{view}`"))


def project(spark: SparkSession, df: DataFrame, spec: SyncSpec) -> DataFrame:
    if spec.transform_sql:
        return apply_transform(spark, df, spec.transform_sql)
    if spec.fields:
        return df.select(*[F.col(f"`{c}`") for c in spec.fields])
    return df


def _seq() -> int:
    return time.time_ns()


class StateStore:
    """The ledger table, dead letters and the published tables, under one root.

    Ledger rows are buffered on the driver and written together at each stage
    boundary (one small append per stage, not one per event); a checkpoint
    row always flushes, so everything a resume needs is durable.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = TableStore(spark, f"{self.root}/tables/default")
        self._stores: dict[str, TableStore] = {"default": self.tables}
        self._ledger = Ledger(spark, self.root, LEDGER_SCHEMA)
        self._pending: list[tuple] = []
        # Cursors this store saved or read (one writer per table, as for pointers).
        self._cursors: dict[tuple[str, str], str | None] = {}

    def tables_of(self, client: str) -> TableStore:
        """A client's published tables; its session views are named
        ``<client>__<table>`` (those of ``default``: ``<table>``)."""
        if client not in self._stores:
            self._stores[client] = TableStore(self.spark, f"{self.root}/tables/{client}",
                                              view_prefix=f"{client}__")
        return self._stores[client]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ---- writing
    def _add(self, kind: str, **values) -> None:
        values.setdefault("created_at", _now())
        values["kind"], values["seq"] = kind, _seq()
        self._pending.append(tuple(values.get(n) for n in _LEDGER_NAMES))

    def flush(self) -> None:
        if self._pending:
            rows, self._pending = self._pending, []
            (self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append")
             .partitionBy("kind").parquet(self.path("ledger")))

    def checkpoint(self, client, pipeline, run_id, stage, data_path=None, cleared=False,
                   value=None, records=None, flush=True):
        self._add("checkpoint", client=client, pipeline=pipeline, run_id=run_id, stage=stage,
                  data_path=data_path, cleared=cleared, value=value, records=records)
        if flush:
            self.flush()

    def stage_checkpoint(self, client: str, pipeline: str, run_id: str, stage: str) -> dict | None:
        """The checkpoint row one stage of one run wrote (cursor and counts)."""
        log = self.ledger("checkpoint").where(
            (F.col("client") == client) & (F.col("pipeline") == pipeline)
            & (F.col("run_id") == run_id) & (F.col("stage") == stage))
        row = log.agg(F.max_by(F.struct("value", "records"), "seq").alias("c")).first()
        return None if row is None or row["c"] is None else row["c"].asDict()

    def clear_checkpoint(self, client: str, pipeline: str) -> None:
        self.checkpoint(client, pipeline, None, "CLEARED", cleared=True)

    def save_cursor(self, client, pipeline, run_id, value):
        self._add("cursor", client=client, pipeline=pipeline, run_id=run_id, value=value)
        self._cursors[(client, pipeline)] = value

    def event(self, run_id, event_type, stage, records=None):
        self._add("event", run_id=run_id, event_type=event_type, stage=stage, records=records)

    def run_row(self, run_id, client, pipeline, status, stage=None, started=None, finished=None,
                records_in=None, records_out=None, error=None):
        self._add("run", run_id=run_id, client=client, pipeline=pipeline, status=status, stage=stage,
                  started_at=started, finished_at=finished, records_in=records_in,
                  records_out=records_out, error=error)

    # ---- reading (views over the ledger)
    def ledger(self, kind: str) -> DataFrame:
        """The ledger's rows of a kind: its snapshot with the log's tail on top."""
        return self._ledger.read(kind)

    def fold(self) -> int:
        """Maintenance: fold the log into the snapshot (``plans.snapshot``)."""
        self.flush()
        return self._ledger.fold()

    def runs(self) -> DataFrame:
        """One row per run: start and finish rows folded (R-03)."""
        from tablesync.operators.ledger import run_fold

        return run_fold(self.ledger("run"))

    def events(self) -> DataFrame:
        return self.ledger("event").select("run_id", "event_type", "stage", "records", "created_at", "seq")

    def checkpoints(self) -> DataFrame:
        return self.ledger("checkpoint").select("client", "pipeline", "run_id", "stage", "data_path",
                                                 F.col("created_at").alias("completed_at"), "seq", "cleared")

    def last_checkpoint(self, client: str, pipeline: str) -> dict | None:
        log = self.checkpoints().where((F.col("client") == client) & (F.col("pipeline") == pipeline))
        row = log.agg(F.max_by(F.struct("run_id", "stage", "data_path", "cleared"), "seq").alias("l")).first()
        if row is None or row["l"] is None or row["l"]["cleared"]:
            return None
        return row["l"].asDict()

    def saved_cursor(self, client: str, pipeline: str) -> str | None:
        if (client, pipeline) in self._cursors:
            return self._cursors[(client, pipeline)]
        log = self.ledger("cursor").where((F.col("client") == client) & (F.col("pipeline") == pipeline))
        row = log.agg(F.max_by("value", "seq").alias("v")).first()
        value = None if row is None else row["v"]
        self._cursors[(client, pipeline)] = value
        return value


def _now():
    import datetime as _dt
    return _dt.datetime.now(_dt.timezone.utc)


def sync_table(spark: SparkSession, spec: SyncSpec,
               source: Callable[[str | None], DataFrame], state: StateStore,
               client: str = "default", from_checkpoint: bool = False,
               fail_after: str | None = None, now: str | None = None) -> SyncResult:
    """Synchronise one table.  Never raises: a failure is a failed result with
    a redacted error, and the previous published generation stays current.

    ``source(since)`` returns the raw rows (lazy); ``since`` is the saved
    cursor in incremental mode (without one: yesterday 00:00 in the source's
    zone, relative to ``now`` -- UTC text, default the current time; a key that
    is a number has no such bound and starts from the first row).
    ``fail_after`` injects a crash after a stage (tests of resume).
    """
    ctx: dict = {}
    pipeline = spec.name
    resume = state.last_checkpoint(client, pipeline) if from_checkpoint else None
    if resume and resume["stage"] == "VERIFY":
        resume = None  # a completed run starts fresh
    run_id = resume["run_id"] if resume else f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:6]}"
    done = STAGES.index(resume["stage"]) if resume else -1
    started = _now()
    state.run_row(run_id, client, pipeline, "RUNNING", started=started)
    stage_dir = f"{state.root}/staging/{client}/{pipeline}/run={run_id}"
    tables = state.tables_of(client)

    def skip(stage: str) -> bool:
        return STAGES.index(stage) <= done

    def finish_stage(stage: str, value: str | None = None, records: int | None = None,
                     flush: bool = True):
        state.event(run_id, "stage_done", stage, ctx.get("extracted"))
        state.checkpoint(client, pipeline, run_id, stage, data_path=stage_dir,
                         value=value, records=records, flush=flush)
        if fail_after == stage:
            raise RuntimeError(f"injected failure after {stage}")

    try:
        incremental = spec.mode == "incremental" and spec.replication_key is not None
        since = state.saved_cursor(client, pipeline) if incremental else None
        if incremental and since is None and not spec.numeric_cursor:
            # No saved cursor: yesterday 00:00 in the source's zone (S-05).
            since = lookback_text(spark, now)

        ctx["since"] = since

        # ---------------------------------------------------------- EXTRACT
        landed_dir = f"{stage_dir}/landed"
        if skip("EXTRACT"):
            state.event(run_id, "stage_skipped", "EXTRACT")
            ctx["staged"] = spark.read.parquet(landed_dir).count()
            # The raw count and the cursor were observed by the original
            # extraction and kept in its checkpoint row.
            saved = state.stage_checkpoint(client, pipeline, run_id, "EXTRACT") or {}
            ctx["extracted"] = saved.get("records") if saved.get("records") is not None else ctx["staged"]
            ctx["new_cursor"] = saved.get("value")
        else:
            state.event(run_id, "stage_start", "EXTRACT")
            raw = source(since)
            numeric = spec.numeric_cursor
            if spec.replication_key and spec.replication_key in raw.columns:
                numeric = numeric or isinstance(raw.schema[spec.replication_key].dataType, T.NumericType)
            if incremental and numeric and since is not None and not is_number(since):
                # A look-back, or a cursor saved when the key was a date, bounds no number.
                since = None
                raw = source(None)
            if incremental:
                raw = delta_filter(raw, spec.replication_key, since, numeric)
            metrics = [F.count(F.lit(1)).alias("n")]
            if spec.replication_key:
                # The cursor comes from the raw rows, before cleaning / transform.
                metrics.append(cursor_candidate(spec.replication_key, numeric).alias("cursor"))
            raw_obs, out_obs = Observation("raw"), Observation("landed")
            landed = strip_nul_all(project(spark, sanitize(raw.observe(raw_obs, *metrics)), spec))
            out_metrics = [F.count(F.lit(1)).alias("n")]
            if _has_keys(landed, spec.pk):
                out_metrics.append(key_bytes(spec.pk).alias("key_bytes"))
            if spec.narrow:
                # The narrowing decision rides on the landing write's own scan.
                out_metrics += narrow_metrics(landed)
            write_staged(landed.observe(out_obs, *out_metrics), landed_dir)
            observed = out_obs.get
            ctx["extracted"] = int(raw_obs.get["n"])
            ctx["staged"] = int(observed["n"])
            ctx["key_bytes"] = observed.get("key_bytes")
            if spec.narrow:
                ctx["narrow_plan"] = plan_from_metrics(landed, observed)
            ctx["new_cursor"] = raw_obs.get.get("cursor")
            finish_stage("EXTRACT", value=ctx["new_cursor"], records=ctx["extracted"])

        if ctx["extracted"] == 0:
            # Nothing new: success, target untouched.
            state.run_row(run_id, client, pipeline, "SUCCESS", stage="VERIFY", finished=_now(),
                          records_in=0, records_out=0)
            state.checkpoint(client, pipeline, run_id, "VERIFY", data_path=stage_dir)  # flushes
            return SyncResult(pipeline, 0, 0, "success", run_id=run_id, counts=dict(ctx))

        # Text columns holding only dates / timestamps are narrowed, as a JSON
        # staging scan would type them (P-05): one aggregate over the landed
        # files decides; the casts ride along with the next write.
        landed_df = staged_scan(spark, landed_dir)
        narrowing = {}
        if spec.narrow:
            # Observed during EXTRACT; recomputed (one aggregate) after a resume.
            narrowing = ctx.get("narrow_plan")
            if narrowing is None:
                narrowing = narrow_plan(landed_df)
        current = tables.current(pipeline) if spec.mode != "full" else None
        if current is not None:
            # A delta follows the published table: a column it already has is
            # narrowed only to that column's own types.
            narrowing = {p: t for p, t in narrowing.items() if p[0] not in current.columns
                         or type_at(current.schema, p) == T.DataType.fromDDL(t)}
        ctx["narrowed"] = narrowing
        typed = apply_narrowing(landed_df, narrowing)

        # --------------------------------------------------------- VALIDATE
        load_from, columns = landed_dir, None
        if spec.contract:
            checked = f"{stage_dir}/checked"
            columns = [f.name for f in spec.contract]
            if skip("VALIDATE"):
                state.event(run_id, "stage_skipped", "VALIDATE")
                ctx["valid"] = (spark.read.parquet(checked).where(F.col("_part") == "valid").count()
                                if path_exists(checked, spark) else 0)
            else:
                state.event(run_id, "stage_start", "VALIDATE")
                ann = ct.annotate(typed, spec.contract)
                valid = F.col("_valid")
                obs = Observation("validate")
                metrics = [F.count(F.lit(1)).alias("n"), F.sum(valid.cast("int")).alias("valid")]
                kcols = [f"_v_{k}" for k in ([spec.pk] if isinstance(spec.pk, str) else spec.pk)]
                if all(c in ann.columns for c in kcols):
                    metrics.append(F.sum(F.when(valid, _row_key_bytes(kcols))).alias("key_bytes"))
                # One pass writes both outputs, split by a partition flag: valid
                # rows (contract columns) and dead letters (record + errors JSON).
                split = ann.observe(obs, *metrics).select(
                    F.when(valid, F.lit("valid")).otherwise(F.lit("dead")).alias("_part"),
                    *[F.col(f"_v_{n}").alias(n) for n in columns],
                    F.lit(run_id).alias("run_id"), F.lit(pipeline).alias("stream"),
                    F.when(~valid, F.col("_record")).alias("record"),
                    F.when(~valid, ct.errors_json()).alias("errors"),
                )
                split.write.mode("overwrite").partitionBy("_part").parquet(checked)
                n_valid = int(obs.get["valid"] or 0)
                n_dead = int(obs.get["n"]) - n_valid
                ctx["key_bytes"] = obs.get.get("key_bytes")
                if not n_valid:
                    # No valid row: the folder still tells readers the columns.
                    (spark.read.parquet(checked).drop("_part").limit(0).coalesce(1)
                     .write.mode("overwrite").parquet(f"{checked}/_part=valid"))
                if n_dead:
                    # One folder per run, replaced: a resumed run files each letter once.
                    (spark.read.parquet(f"{checked}/_part=dead")
                     .select("stream", "record", "errors", F.current_timestamp().alias("created_at"))
                     .write.mode("overwrite").parquet(f"{state.path('dead_letters')}/run_id={run_id}"))
                ctx["valid"], ctx["dead"] = n_valid, n_dead
                finish_stage("VALIDATE")
            load_from = f"{checked}/_part=valid"

        # ------------------------------------------------------------- LOAD
        # A generation of the table: all buckets in full mode and on a first
        # delta, else the buckets that hold a staged key.  Nothing names it yet.
        staged = staged_scan(spark, load_from).select(*columns) if columns else typed
        expected = ctx.get("valid", ctx["staged"])
        if spec.dedupe and spec.replication_key:
            expected = ctx["expected"] = distinct_keys(staged, spec.pk)
            staged = latest_per_key(staged, spec.pk, spec.replication_key)
        if skip("LOAD"):
            state.event(run_id, "stage_skipped", "LOAD")
            written = Written.from_json(state.stage_checkpoint(client, pipeline, run_id, "LOAD")["value"])
        else:
            state.event(run_id, "stage_start", "LOAD")
            if ctx["extracted"] > 0 and not expected:
                raise VerificationError(f"nothing would be loaded although {ctx['extracted']} rows came in")
            if spec.mode != "full":
                if current is not None:
                    check_types(current, staged)
                kb = ctx.get("key_bytes")
                written = tables.write_delta(pipeline, staged, spec.pk, run_id,
                                             None if kb is None else expected, kb)
            else:
                written = tables.write_full(pipeline, staged, run_id, spec.pk, expected)
            finish_stage("LOAD", value=written.to_json())

        # ----------------------------------------------------------- VERIFY
        # Count what is on disk (parquet metadata) before anything becomes
        # visible: a failed check leaves the old state current.
        on_disk = spark.read.schema("_none int").parquet(written.path).count()
        ctx["loaded"] = written.loaded
        if on_disk != written.written:
            raise VerificationError(f"{on_disk} rows on disk, {written.written} were written")
        if written.loaded != expected:
            raise VerificationError(f"the written rows ({written.loaded}) are not the {expected} to be loaded")
        tables.swap(written)
        if ctx.get("new_cursor") is not None:
            state.save_cursor(client, pipeline, run_id, ctx["new_cursor"])
        state.run_row(run_id, client, pipeline, "SUCCESS", stage="VERIFY", finished=_now(),
                      records_in=ctx["extracted"], records_out=ctx["loaded"])
        finish_stage("VERIFY")  # one append: cursor, run row, event, checkpoint
        # The table has its own copy now, and a finished run never resumes.
        delete_path(stage_dir, spark)
        return SyncResult(pipeline, ctx["extracted"], ctx["loaded"], "success", run_id=run_id,
                          counts=dict(ctx))
    except Exception as exc:  # noqa: BLE001 - one table never stops the others
        err = redact_text(str(exc))
        state.run_row(run_id, client, pipeline, "FAILED", finished=_now(),
                      records_in=ctx.get("extracted", 0), error=err)
        state.flush()
        return SyncResult(pipeline, ctx.get("extracted", 0), ctx.get("loaded", 0), "failed",
                          error=err, run_id=run_id, counts=dict(ctx))


def _keys(pk) -> list[str]:
    return [pk] if isinstance(pk, str) else list(pk)


def _no_null(pk):
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in _keys(pk)])


def latest_per_key(staged: DataFrame, pk, replication_key: str) -> DataFrame:
    """The row with the greatest replication key per key (a null one comes
    first); rows with a null in their key stay, each."""
    row = F.max_by(F.struct(*staged.columns), F.struct(F.col(f"`{replication_key}`"))).alias("_r")
    keyed = staged.where(_no_null(pk)).groupBy(*_keys(pk)).agg(row).select("_r.*")
    return keyed.unionByName(staged.where(~_no_null(pk)))


def distinct_keys(staged: DataFrame, pk) -> int:
    """How many rows ``latest_per_key`` keeps."""
    return (staged.where(_no_null(pk)).select(*_keys(pk)).distinct().count()
            + staged.where(~_no_null(pk)).count())


def check_types(current: DataFrame, staged: DataFrame) -> None:
    """Fail the run with the columns at fault when a staged value cannot be
    cast to the type its column has in the published table.  One aggregate over
    the staged rows, only for columns whose types differ."""
    from tablesync.functions.types import added_column_type

    have = {f.name: f.dataType for f in current.schema.fields}
    checks = []
    for f in staged.schema.fields:
        target = have.get(f.name)
        if target is None or target == f.dataType or added_column_type(f.dataType) == target:
            continue
        c = F.col(f"`{f.name}`")
        checks.append(F.sum((c.isNotNull() & c.try_cast(target).isNull()).cast("int")).alias(f.name))
    if not checks:
        return
    bad = {k: v for k, v in staged.agg(*checks).first().asDict().items() if v}
    if bad:
        raise VerificationError(f"staged values do not fit the table's column types: {bad}")


def lookback_text(spark: SparkSession, now: str | None = None) -> str:
    """The default look-back as cursor text (one-row evaluation)."""
    from tablesync.operators.cursor import default_lookback

    if now is None:
        import datetime as _dt
        now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return spark.range(1).select(default_lookback(F.lit(now).cast("timestamp_ntz"))).first()[0]


def _has_keys(df: DataFrame, pk) -> bool:
    keys = [pk] if isinstance(pk, str) else list(pk)
    return all(k in df.columns for k in keys)


def _row_key_bytes(cols: list[str]):
    total = None
    for c in cols:
        b = F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
        total = b if total is None else total + b
    return total


def sync_all(spark: SparkSession, specs: list[tuple[SyncSpec, Callable]], state: StateStore,
             client: str = "default", from_checkpoint: bool = False) -> list[SyncResult]:
    """Synchronise several tables; one failure never stops the others."""
    return [sync_table(spark, spec, src, state, client, from_checkpoint) for spec, src in specs]


def summary_payload(client: str, results: list[SyncResult]) -> dict:
    """Run summary for a notification (bounded by the number of tables)."""
    return {
        "client": client,
        "status": "failed" if any(r.status == "failed" for r in results) else "success",
        "streams": [{"stream": r.stream, "status": r.status, "records_loaded": r.records_loaded,
                     "error": r.error} for r in results],
    }
