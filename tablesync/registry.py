"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the given tables (or fixtures Spark derives from them) in full.
The DuckDB twin of every key is in ``tablesync/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions import clean
from tablesync.functions.types import narrow_types
from tablesync.operators import contracts, cursor, ledger, upsert
from tablesync.operators.contracts import Field
from tablesync.plans.publish import TableStore, VerificationError, bucket_of
from tablesync.session import scratch_dir
from tablesync.sources import fixtures as fx
from tablesync.sources import files, paged

PAGE_SIZE = fx.PAGE_SIZE
SINCE = "2024-01-15 00:00:00"          # incremental lower bound for delta_filter
CURRENT_CURSOR = "2024-01-29 12:00:00"  # saved cursor for cursor_max
FAILED_DAY = "1996-03-15"               # the day asked for by failed_on_day
TRANSFORM = ("SELECT o_orderkey, upper(o_orderpriority) AS prio, o_totalprice "
             "FROM {raw} WHERE o_orderstatus = 'F'")
EMPTY_STREAM, SHORT_STREAM = "view", "click"  # what verify_counts finds wanting
SHORT_PAGE = 300                        # records a page really holds in paged_short_pages
SELECTED_FIELDS = ["o_orderkey", "o_orderstatus", "o_totalprice"]

# The FX-1 contract (FIXTURES.md).
FX1_CONTRACT = [
    Field("id", "long"),
    Field("nome", "string"),
    Field("qtd", "int"),
    Field("data_ref", "string", nullable=True),
    Field("status", "string", default="A"),
]

# The FX-14 contract: nested fields.
FX14_CONTRACT = [
    Field("id", "long"),
    Field("cliente", "struct", fields=(Field("codigo", "int"), Field("nome", "string"),
                                       Field("pais", "string", default="BR"))),
    Field("itens", "list", item=Field("item", "struct", fields=(Field("sku", "string"),
                                                                Field("qtd", "int", nullable=True)))),
    Field("tags", "map", item=Field("tag", "int")),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark, sf_dir, name):
    return fx.table(spark, sf_dir, name)


def _upsert(target, staged, pk):
    """Keyed upsert with the staged key set measured first (as the job does from
    its staging observation), so a bounded delta is broadcast."""
    rows, kb = upsert.measure_keys(staged, pk)
    return upsert.delta_upsert(target, staged, pk, staged_rows=rows, staged_key_bytes=kb)


# ------------------------------------------------------------------ upserts
@query
def delta_upsert(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return _upsert(fx.orders_base(o), fx.orders_delta(o), "o_orderkey")


@query
def delta_first_run(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    store = TableStore(spark, scratch_dir(spark, "first-run"))
    return upsert.delta_upsert(store.current("orders"), fx.orders_first(o), "o_orderkey")


@query
def delta_idempotent(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    delta = fx.orders_delta(o)
    once = _upsert(fx.orders_base(o), delta, "o_orderkey")
    return _upsert(once, delta, "o_orderkey")


@query
def full_refresh(spark, sf_dir):
    """Publish base, then full-refresh with the delta through the generation swap."""
    o = _t(spark, sf_dir, "orders")
    store = TableStore(spark, scratch_dir(spark, "full-refresh"))
    store.publish("fx2_full", fx.orders_base(o), run_id="1")
    store.publish("fx2_full", upsert.full_refresh(fx.orders_delta(o)), run_id="2")
    return spark.table("fx2_full")


@query
def delta_dup_pk(spark, sf_dir):
    base, delta = fx.lineitem_split(_t(spark, sf_dir, "lineitem"))
    return _upsert(base, delta, "l_orderkey")


@query
def delta_null_pk(spark, sf_dir):
    base, delta = fx.lineitem_null_split(_t(spark, sf_dir, "lineitem"))
    return _upsert(base, delta, "k")


@query
def schema_evolve(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return _upsert(fx.orders_base(o), fx.orders_delta_wide(o), "o_orderkey")


@query
def schema_missing(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return _upsert(fx.orders_base_wide(o), fx.orders_delta(o), "o_orderkey")


@query
def loaded_count(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    delta = fx.orders_delta(o)
    result = _upsert(fx.orders_base(o), delta, "o_orderkey")
    # One global aggregate over both inputs (no join needed for two counts).
    tagged = result.select(F.lit(1).alias("_t"), F.lit(0).alias("_l")).unionByName(
        delta.select(F.lit(0).alias("_t"), F.lit(1).alias("_l")))
    return tagged.agg(F.sum("_t").cast("long").alias("target_rows"),
                      F.sum("_l").cast("long").alias("loaded"))


@query
def verify_counts(spark, sf_dir):
    """The count check over a published table that lacks rows of one stream
    and all rows of another."""
    raw = fx.dirty_records(_t(spark, sf_dir, "events"), with_stream=True)
    checked = contracts.annotate(clean.sanitize(raw), FX1_CONTRACT).withColumnRenamed("_valid", "valid")
    lost = (F.col("stream") == EMPTY_STREAM) | ((F.col("stream") == SHORT_STREAM) & (F.col("id") % 50 == 7))
    store = TableStore(spark, scratch_dir(spark, "verify"))
    store.publish("verify_target", checked.where(F.col("valid") & ~lost).select("id", "stream"), run_id="1")
    return ledger.verify_counts(checked, store.current("verify_target"))


# ----------------------------------------------------------------- cleaning
@query
def select_fields(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(*[F.col(f"`{c}`") for c in SELECTED_FIELDS])


@query
def transform_sql(spark, sf_dir):
    from tablesync.plans.job import apply_transform
    return apply_transform(spark, _t(spark, sf_dir, "orders"), TRANSFORM)


@query
def sanitize_blank(spark, sf_dir):
    return clean.sanitize_blanks(fx.dirty_records(_t(spark, sf_dir, "events")))


@query
def sanitize_date(spark, sf_dir):
    return clean.sanitize(fx.dirty_records(_t(spark, sf_dir, "events")))


@query
def narrow_types_q(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    raw = fx.dirty_records(ev).withColumn("dia", F.date_format(F.col("ultima_atualizacao"), "yyyy-MM-dd"))
    return narrow_types(clean.sanitize(raw))


@query
def narrow_nested(spark, sf_dir):
    """Text leaves of structs and arrays typed like top-level text."""
    out = narrow_types(fx.nested_text(_t(spark, sf_dir, "events")))
    visit = F.get("visitas", F.lit(0))
    return out.select("id", F.col("meta.criado").alias("criado"), F.col("meta.nota").alias("nota"),
                      F.size("visitas").alias("n"), visit["em"].alias("em"), visit["quem"].alias("quem"),
                      F.get("dias", F.lit(0)).alias("dia"))


@query
def redact(spark, sf_dir):
    msgs = fx.secrets_text(_t(spark, sf_dir, "customer"))
    return msgs.select("c_custkey", clean.redact("message").alias("message"))


@query
def strip_nul(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    raw = c.select("c_custkey", F.concat("c_name", F.lit("\x00"), "c_mktsegment").alias("label"))
    return clean.strip_nul_all(raw)


@query
def to_json_record(spark, sf_dir):
    rec = clean.sanitize(fx.dirty_records(_t(spark, sf_dir, "events")))
    return rec.select("id", clean.to_json_record(rec, "record"))


@query
def json_cursor(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", clean.json_field("props", "$.k").alias("cursor_value"))


@query
def parse_total(spark, sf_dir):
    t = fx.total_texts(_t(spark, sf_dir, "events"))
    return t.select("event_id", "total_raw", clean.parse_total("total_raw").alias("total"))


# ------------------------------------------------------------------- cursor
@query
def delta_filter(spark, sf_dir):
    raw = fx.dirty_records(_t(spark, sf_dir, "events"))
    return cursor.delta_filter(raw, "ultima_atualizacao", SINCE)


@query
def default_lookback(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", cursor.default_lookback("ts").alias("lookback"))


@query
def cursor_max(spark, sf_dir):
    raw = fx.dirty_records(_t(spark, sf_dir, "events"), with_stream=True)
    return raw.groupBy("stream").agg(
        cursor.advance(CURRENT_CURSOR, cursor.cursor_candidate("ultima_atualizacao")).alias("cursor_ts"),
        cursor.cursor_candidate("data_ref").alias("cursor_ref"),
        cursor.cursor_candidate("qtd", numeric=True).alias("cursor_qtd"))


def _cursor_log(events: DataFrame) -> DataFrame:
    meta = F.to_json(F.struct(F.date_format("ts", fx.TS_TEXT).alias("replication_key_value")))
    return events.select(
        F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("client"),
        F.col("event_type").alias("pipeline"), F.col("event_id").alias("seq"), meta.alias("metadata"))


@query
def cursor_lookup(spark, sf_dir):
    log = _cursor_log(_t(spark, sf_dir, "events"))
    log = log.withColumn("value", clean.json_field("metadata", "$.replication_key_value"))
    return cursor.cursor_lookup(log)


# ---------------------------------------------------------------- contracts
def _annotated(spark, sf_dir):
    rec = clean.sanitize(fx.dirty_records(_t(spark, sf_dir, "events")))
    return contracts.annotate(rec, FX1_CONTRACT)


@query
def validate_valid(spark, sf_dir):
    ann = _annotated(spark, sf_dir)
    return ann.where("_valid").select("id", "nome", "data_ref", "qtd", "ultima_atualizacao")


@query
def validate_coerce(spark, sf_dir):
    return contracts.valid_rows(_annotated(spark, sf_dir), FX1_CONTRACT)


@query
def validate_dead(spark, sf_dir):
    dead = contracts.invalid_rows(_annotated(spark, sf_dir))
    return dead.withColumn("_errors", contracts.errors_json()).withColumnRenamed("_errors", "errors")


def _dead_letter_table(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    rec = clean.sanitize(fx.dirty_records(ev, with_created=True))
    ann = contracts.annotate(rec, FX1_CONTRACT, record_columns=[c for c in rec.columns if c != "created_at"])
    return contracts.dead_letters(ann, F.expr("id div 10"), "events",
                                  extra=("id", "created_at"))


@query
def dead_letters(spark, sf_dir):
    return _dead_letter_table(spark, sf_dir).select("run_id", "stream", "record", "errors")


@query
def dead_letters_latest(spark, sf_dir):
    runs = fx.batch_ledger(_t(spark, sf_dir, "events"))
    return ledger.dead_letters_latest(_dead_letter_table(spark, sf_dir), runs)


def _nested(spark, sf_dir):
    return contracts.annotate(clean.sanitize(fx.nested_records(_t(spark, sf_dir, "events"))), FX14_CONTRACT)


@query
def validate_nested(spark, sf_dir):
    """Valid nested records, coerced at every depth (nested fields as JSON)."""
    valid = contracts.valid_rows(_nested(spark, sf_dir), FX14_CONTRACT)
    keep = {"ignoreNullFields": "false"}
    return valid.select("id", F.col("cliente.codigo").alias("codigo"), F.size("itens").alias("n_itens"),
                        *[F.to_json(c, keep).alias(c) for c in ("cliente", "itens", "tags")])


@query
def dead_letters_nested(spark, sf_dir):
    return contracts.dead_letters(_nested(spark, sf_dir), F.expr("id div 10"), "events").select(
        "run_id", "stream", "record", "errors")


# ------------------------------------------------------------------- ledger
def _runs(spark, sf_dir):
    return fx.run_ledger(_t(spark, sf_dir, "orders"))


@query
def status_top20(spark, sf_dir):
    return ledger.status_top(_runs(spark, sf_dir))


@query
def status_top20_client(spark, sf_dir):
    return ledger.status_top(_runs(spark, sf_dir), client="c1")


@query
def failed_on_day(spark, sf_dir):
    return ledger.failed_on_day(_runs(spark, sf_dir), FAILED_DAY).select(
        "client", "pipeline", "run_id", "started_at", "error")


@query
def volume_by_day(spark, sf_dir):
    return ledger.volume_by_day(_runs(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return ledger.run_summary(_runs(spark, sf_dir))


def _run_log(spark, sf_dir):
    """Start and finish rows of the runs."""
    runs = _runs(spark, sf_dir)
    start = runs.select("run_id", "client", F.lit("RUNNING").alias("status"), "started_at",
                        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
                        F.lit(1).alias("seq"), F.lit(None).cast("long").alias("records_out"))
    finish = runs.where(F.col("status") != "RUNNING").select(
        "run_id", F.lit(None).cast("string").alias("client"), "status",
        F.lit(None).cast("timestamp_ntz").alias("started_at"),
        F.expr("timestampadd(SECOND, records_out % 3600, started_at)").alias("finished_at"),
        F.lit(2).alias("seq"), "records_out")
    return start, finish


@query
def run_fold(spark, sf_dir):
    start, finish = _run_log(spark, sf_dir)
    return ledger.run_fold(start.unionByName(finish))


def _append(log, kind: str, rows: DataFrame) -> None:
    (rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)
                   .alias(f.name) for f in log.schema.fields], F.lit(kind).alias("kind"))
     .write.mode("append").partitionBy("kind").parquet(log.log))


def _folded_ledger(spark, sf_dir):
    """A ledger of two folds and a tail: the runs' starts and some finishes,
    more finishes, the rest; checkpoints in between."""
    from tablesync.plans.job import LEDGER_SCHEMA
    from tablesync.plans.snapshot import Ledger

    schema = LEDGER_SCHEMA.replace("timestamp", "timestamp_ntz")
    log = Ledger(spark, scratch_dir(spark, "ledger"), schema)
    start, finish = _run_log(spark, sf_dir)
    steps = _checkpoint_log(_t(spark, sf_dir, "events")).withColumnRenamed("completed_at", "created_at")
    for i in range(3):
        if i == 0:
            _append(log, "run", start)
        _append(log, "run", finish.where(F.col("run_id") % 3 == i))
        _append(log, "checkpoint", steps.where(F.col("seq") % 3 == i))
        if i < 2:
            log.fold()
    return log


@query
def ledger_snapshot(spark, sf_dir):
    """Runs from the snapshot with the tail on top: as folded from the whole log."""
    log = _folded_ledger(spark, sf_dir)
    runs = ledger.run_fold(log.read("run").withColumn("run_id", F.col("run_id").cast("long")))
    return runs.select("run_id", "client", "started_at", "finished_at", "status", "records_out", "duration_s")


@query
def ledger_snapshot_checkpoints(spark, sf_dir):
    """The current checkpoints from snapshot and tail."""
    rows = _folded_ledger(spark, sf_dir).read("checkpoint").withColumnRenamed("created_at", "completed_at")
    return ledger.checkpoint_latest(rows.select("client", "pipeline", "stage", "completed_at", "data_path", "seq", "cleared"))


def _stage_events(events: DataFrame) -> DataFrame:
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("stage_start", "stage_done", "stage_skipped")]),
                         (F.col("event_id") % 3 + 1).cast("int"))
    stage = F.element_at(F.array(*[F.lit(s) for s in ledger.STAGE_ORDER]),
                         (F.col("event_id") % 4 + 1).cast("int"))
    return events.select(
        F.col("user_id").alias("run_id"), kinds.alias("event_type"), stage.alias("stage"),
        F.when(kinds == "stage_done", F.get_json_object("props", "$.k").cast("int")).alias("records"),
        F.col("ts").alias("created_at"))


@query
def event_counts(spark, sf_dir):
    return ledger.event_counts(_stage_events(_t(spark, sf_dir, "events")))


def _checkpoint_log(events: DataFrame) -> DataFrame:
    stage = F.element_at(F.array(*[F.lit(s) for s in ledger.STAGE_ORDER]),
                         (F.col("event_id") % 4 + 1).cast("int"))
    return events.select(
        F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("client"),
        F.col("event_type").alias("pipeline"), stage.alias("stage"),
        F.col("ts").alias("completed_at"),
        F.concat(F.lit("staging/"), F.col("event_type"), F.lit("/run="), F.col("event_id").cast("string"))
        .alias("data_path"),
        F.col("event_id").alias("seq"), (F.col("event_id") % 13 == 0).alias("cleared"))


@query
def checkpoint_latest(spark, sf_dir):
    return ledger.checkpoint_latest(_checkpoint_log(_t(spark, sf_dir, "events")))


@query
def resume_point(spark, sf_dir):
    latest = ledger.checkpoint_latest(_checkpoint_log(_t(spark, sf_dir, "events")))
    return ledger.resume_point(latest).select("client", "pipeline", "stage", "resume_stage")


# -------------------------------------------------------------------- pages
def _page_records(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                         "user_id", "event_type", "value", "props")


def _bodies(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return fx.page_bodies(_page_records(ev), F.col("event_type"), "event_id", PAGE_SIZE)


def _landed_pages(spark, sf_dir):
    """The fetched pages as landed data: materialised once with a reliable
    checkpoint (under spark.checkpoint.dir), so the ledger queries read them
    instead of re-deriving page numbers in every branch of their plan."""
    from tablesync.session import scratch_dir as _ensure_checkpoint_dir

    _ensure_checkpoint_dir(spark, "pages")
    return _bodies(spark, sf_dir).checkpoint(eager=True)


RECORD_SCHEMA = "event_id long, ts string, user_id long, event_type string, value double, props string"


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query
def page_explode(spark, sf_dir):
    rows = paged.explode_pages(_landed_pages(spark, sf_dir))
    parsed = rows.select("endpoint", "page", "total", F.from_json("record", RECORD_SCHEMA).alias("r"))
    return _typed(parsed.select("endpoint", "page", "total", "r.*"))


def _land(spark, bodies) -> str:
    root = scratch_dir(spark, "pages") + "/bodies"
    paged.write_blocks(bodies, root)
    return root


def _write_pages(spark, sf_dir) -> tuple[str, list[str]]:
    endpoints = [r[0] for r in _t(spark, sf_dir, "events").select("event_type").distinct().collect()]
    return _land(spark, _bodies(spark, sf_dir)), sorted(endpoints)


@query
def paged_scan(spark, sf_dir):
    root, endpoints = _write_pages(spark, sf_dir)
    # Page bodies come through the source untouched; records are exploded
    # and parsed on the JVM.
    pages = paged.paged_scan(spark, endpoints, path=root, page_size=PAGE_SIZE, output="pages")
    return _typed(paged.parse_records(paged.explode_pages(pages), RECORD_SCHEMA))


@query
def paged_delta_scan(spark, sf_dir):
    """Incremental scan: the fetcher gets ``since``, records before it go."""
    root, endpoints = _write_pages(spark, sf_dir)
    raw = paged.paged_scan(spark, endpoints, path=root, page_size=PAGE_SIZE, replication_key="ts", since=SINCE)
    return _typed(paged.parse_records(raw, RECORD_SCHEMA))


@query
def paged_pushdown(spark, sf_dir):
    """The cursor filter of a lazy scan: pushed to the fetcher as ``since`` and
    evaluated again on the JVM; the endpoint filter leaves the others unread."""
    root, endpoints = _write_pages(spark, sf_dir)
    raw = paged.record_scan(spark, endpoints, "ts", path=root, page_size=PAGE_SIZE)
    raw = raw.where((F.col("cursor") >= SINCE) & F.col("endpoint").isin(EMPTY_STREAM, SHORT_STREAM))
    return _typed(paged.parse_records(raw, RECORD_SCHEMA))


@query
def paged_short_pages(spark, sf_dir):
    """A server that gives fewer records per page than asked, and no total for
    one endpoint: all records arrive."""
    ev = _t(spark, sf_dir, "events")
    bodies = fx.page_bodies(_page_records(ev), F.col("event_type"), "event_id", SHORT_PAGE)
    untold = F.regexp_replace("body", '"total":"[0-9]+"', '"total":""')
    bodies = bodies.withColumn("body", F.when(F.col("endpoint") == SHORT_STREAM, untold).otherwise(F.col("body")))
    endpoints = sorted(r[0] for r in ev.select("event_type").distinct().collect())
    pages = paged.paged_scan(spark, endpoints, path=_land(spark, bodies), page_size=PAGE_SIZE,
                             pages_per_partition=3, output="pages")
    return _typed(paged.parse_records(paged.explode_pages(pages), RECORD_SCHEMA))


def _progress(spark, sf_dir):
    return ledger.page_progress(ledger.page_ledger(_landed_pages(spark, sf_dir)), PAGE_SIZE)


@query
def page_progress(spark, sf_dir):
    return _progress(spark, sf_dir)


@query
def page_eta(spark, sf_dir):
    """Time left after each page, by the pages' own clock (FX-12)."""
    scratch_dir(spark, "pages")  # registers the checkpoint folder
    pages = fx.timed_pages(_t(spark, sf_dir, "events"), PAGE_SIZE).checkpoint(eager=True)
    prog = ledger.page_progress(ledger.page_ledger(pages), PAGE_SIZE)
    return ledger.page_eta(prog).select("endpoint", "page", "fetched", "total", "elapsed_s", "eta_s")


# -------------------------------------------------------------------- files
@query
def ndjson_scan(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    path = scratch_dir(spark, "ndjson")
    files.write_ndjson(o.withColumn("o_orderdate", F.date_format("o_orderdate", fx.TS_TEXT)), path + "/orders")
    return files.ndjson_scan(spark, path + "/orders")


@query
def staging_scan(spark, sf_dir):
    """Staged rows of a run, read back whole."""
    path = scratch_dir(spark, "staging") + "/run=1"
    files.write_staged(clean.sanitize(fx.dirty_records(_t(spark, sf_dir, "events"))), path)
    return files.staged_scan(spark, path)


@query
def staging_replace(spark, sf_dir):
    """A second attempt replaces what the first one staged."""
    ev = _t(spark, sf_dir, "events")
    path = scratch_dir(spark, "staging") + "/run=1"
    files.write_staged(fx.dirty_records(ev), path)
    files.write_staged(fx.later_records(ev), path)
    return files.staged_scan(spark, path)


# ---------------------------------------------------------------- streaming
@query
def stream_upsert(spark, sf_dir):
    from tablesync.streaming.upsert_stream import run_stream_upsert
    o = _t(spark, sf_dir, "orders")
    work = scratch_dir(spark, "stream")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_channel string"
    fx.orders_base(o).withColumn("o_channel", F.lit(None).cast("string")) \
        .repartition(3).write.parquet(f"{work}/input/base")
    fx.orders_delta(o).repartition(3).write.parquet(f"{work}/input/delta")
    store = TableStore(spark, f"{work}/tables")
    run_stream_upsert(spark, f"{work}/input/*", schema, "fx2_stream", "o_orderkey", store,
                      checkpoint=f"{work}/checkpoint", files_per_batch=1)
    return store.current("fx2_stream")


@query
def paged_stream(spark, sf_dir):
    """The paged source as a stream whose offset is the cursor: drained, then
    started again with the same checkpoint folder on later pages."""
    from tablesync.streaming.upsert_stream import drain
    root, endpoints = _write_pages(spark, sf_dir)
    later = fx.later_events(_t(spark, sf_dir, "events"))
    later_root = _land(spark, fx.page_bodies(_page_records(later), F.col("event_type"), "event_id", PAGE_SIZE))
    work = scratch_dir(spark, "paged-stream")
    store = TableStore(spark, f"{work}/tables")
    for path in (root, later_root):
        source = paged.endpoint_stream(spark, endpoints, RECORD_SCHEMA, "ts", path=path, page_size=PAGE_SIZE)
        drain(spark, source, "events_stream", "event_id", store, f"{work}/checkpoint")
    return _typed(store.current("events_stream"))


# ---------------------------------------------------------------------- job
def _run(spark, spec, source, state, client="c0"):
    from tablesync.plans.job import sync_table
    res = sync_table(spark, spec, source, state, client=client)
    if res.status != "success":
        raise RuntimeError(f"sync failed: {res.error}")
    return res


@query
def sync_job(spark, sf_dir):
    """A full run, then an incremental run over a source that has changed, new
    and rejected records since; both must succeed."""
    from tablesync.plans.job import StateStore, SyncSpec
    ev = _t(spark, sf_dir, "events")
    state = StateStore(spark, scratch_dir(spark, "state"))
    for mode, rows in (("full", fx.dirty_records(ev)), ("incremental", fx.later_records(ev))):
        spec = SyncSpec(name="eventos", pk="id", replication_key="ultima_atualizacao", mode=mode,
                        contract=FX1_CONTRACT)
        _run(spark, spec, lambda since, rows=rows: cursor.delta_filter(rows, "ultima_atualizacao", since), state)
    return state.tables_of("c0").current("eventos")


@query
def paged_sync(spark, sf_dir):
    """The sync job over the paged source: a full run, then an incremental run
    over later pages whose cursor the fetcher gets."""
    from tablesync.plans.job import StateStore, SyncSpec
    root, endpoints = _write_pages(spark, sf_dir)
    later = fx.later_events(_t(spark, sf_dir, "events"))
    later_root = _land(spark, fx.page_bodies(_page_records(later), F.col("event_type"), "event_id", PAGE_SIZE))
    state = StateStore(spark, scratch_dir(spark, "paged-state"))
    for mode, path in (("full", root), ("incremental", later_root)):
        source = paged.endpoint_source(spark, endpoints, RECORD_SCHEMA, replication_key="ts", path=path,
                                       page_size=PAGE_SIZE)
        spec = SyncSpec(name="events_api", pk="event_id", replication_key="ts", mode=mode)
        _run(spark, spec, source, state)
    return state.tables_of("c0").current("events_api")


@query
def cursor_numeric(spark, sf_dir):
    """Incremental runs over a number key: the first has no bound, the second
    starts from the greatest number (not the greatest text)."""
    from tablesync.plans.job import StateStore, SyncSpec
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "value")
    new = ev.where(F.col("event_id") % 10 == 3).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    state = StateStore(spark, scratch_dir(spark, "numeric-state"))
    for rows in (ev, ev.withColumn("value", F.col("value") + 1).unionByName(new)):
        _run(spark, SyncSpec(name="numeros", pk="event_id", replication_key="event_id", mode="incremental"),
             lambda since, rows=rows: rows, state)
    return state.tables_of("c0").current("numeros")


@query
def cursor_raw(spark, sf_dir):
    """The saved cursor comes from the raw rows, also when the projection
    leaves its column out."""
    from tablesync.plans.job import StateStore, SyncSpec
    state = StateStore(spark, scratch_dir(spark, "raw-state"))
    spec = SyncSpec(name="eventos", pk="id", replication_key="ultima_atualizacao", fields=("id", "nome"))
    _run(spark, spec, lambda since: fx.dirty_records(_t(spark, sf_dir, "events")), state)
    return state.ledger("cursor").select("client", "pipeline", F.col("value").alias("cursor"))


@query
def dedupe_latest(spark, sf_dir):
    from tablesync.plans.job import latest_per_key
    return latest_per_key(fx.keyed_changes(_t(spark, sf_dir, "lineitem")), "k", "changed")


@query
def publish_delta(spark, sf_dir):
    """A published delta; one without the key column is refused and leaves the
    table as it was."""
    o = _t(spark, sf_dir, "orders")
    store = TableStore(spark, scratch_dir(spark, "publish-delta"))
    store.publish("fx2_published", fx.orders_base(o), run_id="1", pk="o_orderkey")
    store.publish_delta("fx2_published", fx.orders_delta(o), "o_orderkey", run_id="2")
    try:
        store.publish_delta("fx2_published", fx.orders_delta(o).drop("o_orderkey"), "o_orderkey", run_id="3")
    except VerificationError:
        return TableStore(spark, store.root).current("fx2_published")
    raise RuntimeError("a delta without its key was published")


@query
def publish_buckets(spark, sf_dir):
    """Two daily deltas on a table of many key buckets: each rewrites the
    buckets of its keys only (all of them, where the day's keys reach all)."""
    o = _t(spark, sf_dir, "orders")
    store = TableStore(spark, scratch_dir(spark, "publish-buckets"), min_buckets=256)
    buckets = store.publish("fx13", fx.orders_first(o), run_id="1", pk="o_orderkey").buckets
    day = fx.orders_last_day(o)
    # At most one row a bucket.
    own = {str(r[0]) for r in day.where(F.col("o_orderkey").isNotNull()).select(
        bucket_of(day, ["o_orderkey"], buckets)).distinct().collect()}
    for run_id in ("2", "3"):
        before = store.state("fx13")["folders"]
        written = store.publish_delta("fx13", day.withColumn("o_totalprice", F.col("o_totalprice") + int(run_id)),
                                      "o_orderkey", run_id=run_id)
        others = {b for b, folder in written.folders.items() if folder != before.get(b)} - own
        # Without any key one bucket takes the rows; a table cut into more buckets is written anew.
        if len(others) > (0 if own else 1) and written.buckets == buckets:
            raise RuntimeError("a daily delta rewrote buckets that hold none of its keys")
    return store.current("fx13")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(QUERIES)
    out["narrow_types"] = out.pop("narrow_types_q")
    return out
