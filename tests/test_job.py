"""Sync job lifecycle: full, incremental, empty, failures, resume, publish."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablesync.operators.contracts import Field
from tablesync.plans.job import StateStore, SyncSpec, summary_payload, sync_table
from tablesync.plans.publish import TableStore, VerificationError

ROWS = [(1, "ana", "2024-01-01 10:00:00"), (2, " ", "2024-01-02 10:00:00"),
        (3, "caio", "0000-00-00 00:00:00"), (4, "dora", "2024-01-03 10:00:00")]
SCHEMA = "id long, nome string, ultima_atualizacao string"


def _source(spark, rows=ROWS):
    return lambda since: spark.createDataFrame(rows, SCHEMA)


def _table(state, name, client="default"):
    return sorted(tuple(r) for r in state.tables_of(client).current(name).collect())


def test_full_then_incremental(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("clientes", pk="id", replication_key="ultima_atualizacao", mode="incremental")
    full = SyncSpec("clientes", pk="id", replication_key="ultima_atualizacao", mode="full")
    first = sync_table(spark, full, _source(spark), state, client="acme")
    assert first.status == "success" and first.records_extracted == 4 and first.records_loaded == 4
    # Blank and impossible dates are NULL in the published table, and the
    # all-timestamp text column is narrowed to a timestamp.
    assert _table(state, "clientes", "acme")[1] == (2, None, dt.datetime(2024, 1, 2, 10))
    assert dict(state.tables_of("acme").current("clientes").dtypes)["ultima_atualizacao"] == "timestamp_ntz"
    assert state.saved_cursor("acme", "clientes") == "2024-01-03 10:00:00"
    changed = ROWS + [(2, "bia", "2024-01-04 10:00:00")]
    second = sync_table(spark, spec, _source(spark, changed), state, client="acme")
    # Only rows at or after the cursor are extracted (inclusive boundary).
    assert second.records_extracted == 2
    assert _table(state, "clientes", "acme")[1] == (2, "bia", dt.datetime(2024, 1, 4, 10))
    assert state.saved_cursor("acme", "clientes") == "2024-01-04 10:00:00"
    assert state.tables_of("acme").current("clientes").count() == 4
    runs = state.runs().orderBy("started_at").collect()
    assert [r.status for r in runs] == ["SUCCESS", "SUCCESS"] and runs[1].records_out == 2
    done = state.events().where("event_type = 'stage_done'").groupBy("stage").count().collect()
    assert {r.stage: r["count"] for r in done} == {"EXTRACT": 2, "LOAD": 2, "VERIFY": 2}


def test_empty_extraction_is_a_successful_no_op(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id")
    sync_table(spark, spec, _source(spark), state)
    before = _table(state, "t")
    res = sync_table(spark, spec, _source(spark, []), state)
    assert res.status == "success" and res.records_extracted == 0 and _table(state, "t") == before


def test_contract_rejects_go_to_dead_letters(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", contract=[Field("id", "long"), Field("nome", "string")])
    res = sync_table(spark, spec, _source(spark), state, client="acme")
    assert res.status == "success" and res.records_loaded == 3
    dead = spark.read.parquet(state.path("dead_letters")).collect()
    assert len(dead) == 1 and '"type":"string_type"' in dead[0].errors
    assert state.tables_of("acme").current("t").columns == ["id", "nome"]


def test_failure_is_redacted_and_keeps_old_table(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id")
    sync_table(spark, spec, _source(spark), state)
    before = _table(state, "t")

    def broken(since):
        raise RuntimeError("cannot reach postgresql://etl:senha@db/x")

    res = sync_table(spark, spec, broken, state)
    assert res.status == "failed" and "senha" not in res.error and "***" in res.error
    assert _table(state, "t") == before
    assert summary_payload("acme", [res])["status"] == "failed"


@pytest.mark.parametrize("stage", ["EXTRACT", "VALIDATE", "LOAD"])
def test_kill_after_stage_then_resume(spark, workdir, stage):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", contract=[Field("id", "long"), Field("nome", "string", nullable=True)])
    crashed = sync_table(spark, spec, _source(spark), state, fail_after=stage)
    assert crashed.status == "failed"
    calls = []

    def counting(since):
        calls.append(since)
        return spark.createDataFrame(ROWS, SCHEMA)

    resumed = sync_table(spark, spec, counting, state, from_checkpoint=True)
    assert resumed.status == "success" and resumed.run_id == crashed.run_id
    assert calls == []  # staged parquet reused, source not read again
    clean = StateStore(spark, workdir + "-ref")
    sync_table(spark, spec, _source(spark), clean)
    assert _table(state, "t") == _table(clean, "t")


def test_publish_count_mismatch_leaves_view(spark, workdir):
    store = TableStore(spark, workdir)
    store.publish("v", spark.range(3), run_id="1")
    with pytest.raises(VerificationError):
        store.publish("v", spark.range(5), run_id="2", expected=4)
    assert spark.table("v").count() == 3 and store.current("v").count() == 3


def test_generation_swap_changes_types(spark, workdir):
    store = TableStore(spark, workdir)
    store.publish("w", spark.range(2).select(F.col("id").cast("string").alias("id")), run_id="1")
    store.publish("w", spark.range(2), run_id="2")
    assert dict(spark.table("w").dtypes)["id"] == "bigint"


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def test_deltas_equal_sequential_upserts(spark, workdir):
    from tablesync.operators.upsert import delta_upsert

    store = TableStore(spark, workdir)
    base = spark.createDataFrame([(i, f"b{i}") for i in range(100)], "id long, v string")
    store.publish("l", base, run_id="0", pk="id")
    expected = base
    for n in range(1, 6):
        delta = spark.createDataFrame([(i, f"d{n}-{i}") for i in range(n * 10, n * 10 + 15)] + [(None, "x")],
                                      "id long, v string")
        if n == 4:
            delta = delta.withColumn("extra", F.lit(n))
        written = store.publish_delta("l", delta, "id", run_id=str(n), expected=16)
        expected = delta_upsert(expected, delta, "id")
        assert _sorted(store.current("l")) == _sorted(expected)
        assert written.rows == expected.count() and written.loaded == 16
    assert store.state("l", refresh=True)["run_id"] == "5"
    assert store.current("l").columns == ["id", "v", "extra"]


def _files(workdir, folder):
    from pathlib import Path

    return {p.name: p.stat().st_mtime_ns for p in Path(workdir, "t", folder).iterdir()}


def test_a_delta_rewrites_only_the_buckets_of_its_keys(spark, workdir):
    store = TableStore(spark, workdir, min_buckets=16)
    store.publish("t", spark.range(2000).select("id", (F.col("id") % 7).alias("v")), run_id="0", pk="id")
    before = dict(store.state("t")["folders"])
    files = {b: _files(workdir, f) for b, f in before.items()}
    delta = spark.createDataFrame([(5, -1), (6, -1), (None, -1)], "id long, v long")
    written = store.publish_delta("t", delta, "id", run_id="1")
    after = store.state("t", refresh=True)["folders"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(before) == 16 and 1 <= len(changed) <= 2
    assert all(_files(workdir, before[b]) == files[b] for b in before)  # the old state is whole, too
    assert written.written < 2000 / 16 * 2 * 1.5 and written.rows == 2001
    assert store.current("t").where("v = -1").count() == 3 and store.current("t").count() == 2001
    # Only rows without a key: one bucket takes them.
    store.publish_delta("t", delta.where("id IS NULL"), "id", run_id="2")
    assert sum(store.state("t")["folders"][b] != after[b] for b in after) == 1
    assert store.current("t").where("id IS NULL").count() == 2


def test_a_day_may_reach_all_buckets_but_no_other(spark, workdir, monkeypatch):
    from tablesync import registry

    def orders(folder, rows, days):
        spark.range(rows).select(
            F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            F.col("id").cast("double").alias("o_totalprice"),
            F.expr(f"timestamp_ntz'2001-01-01' + make_dt_interval(cast(id % {days} as int))").alias("o_orderdate"),
        ).write.parquet(f"{workdir}/{folder}/orders.parquet")
        return f"{workdir}/{folder}"

    # All 256 buckets hold keys of the last day: both deltas are published.
    rows = registry.publish_buckets(spark, orders("all", 4000, 1)).collect()
    assert len(rows) == 4000 and all(r.o_totalprice == r.o_orderkey + 1003 for r in rows)
    # A store that rewrites other buckets as well is caught.
    original = TableStore.write_delta

    def careless(self, table, staged, *args, **kw):
        done = original(self, table, staged, *args, **kw)
        return replace(done, folders={b: f"./{f}" for b, f in done.folders.items()})  # other names, same rows

    monkeypatch.setattr(TableStore, "write_delta", careless)
    with pytest.raises(RuntimeError, match="none of its keys"):
        registry.publish_buckets(spark, orders("few", 600, 300))


def test_a_failed_publish_leaves_the_old_pointer(spark, workdir, monkeypatch):
    store = TableStore(spark, workdir)
    store.publish("f", spark.range(50), run_id="0", pk="id")
    with pytest.raises(VerificationError):
        store.publish_delta("f", spark.range(40, 60), "id", run_id="1", expected=21)

    def lost(self, written):
        raise RuntimeError("driver lost before the pointer row")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "swap", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            store.publish_delta("f", spark.range(40, 60), "id", run_id="2")
    fresh = TableStore(spark, workdir)
    assert fresh.state("f")["run_id"] == "0" and fresh.current("f").count() == 50
    fresh.publish_delta("f", spark.range(40, 60), "id", run_id="3")
    assert fresh.current("f").count() == 60


def test_vacuum_deletes_what_no_recent_state_names(spark, workdir):
    store = TableStore(spark, workdir)
    store.publish("t", spark.range(100), run_id="0", pk="id")
    with pytest.raises(VerificationError):
        store.publish("t", spark.range(5), run_id="orphan", expected=6)
    for n in range(1, 4):
        store.publish_delta("t", spark.range(n, n + 2), "id", run_id=str(n))
    previous = store.current("t")
    store.publish("t", spark.range(10), run_id="4", pk="id")
    gone = store.vacuum("t", keep=2)
    assert any("orphan" in f for f in gone) and store.superseded("t", keep=2) == []
    assert previous.count() == 100 and store.current("t").count() == 10
    assert store.vacuum("t", keep=1) and store.current("t").count() == 10
    assert store.vacuum("none") == []
    fresh = TableStore(spark, workdir)
    assert fresh.state("t")["run_id"] == "4" and fresh.current("t").count() == 10
    assert spark.read.parquet(store.pointer_path).count() == 1


def test_vacuum_keeps_what_streams_may_replay(spark, workdir):
    store = TableStore(spark, workdir)
    store.publish("other", spark.range(3), run_id="x", pk="id")
    for run_id in ("q1:0", "q2:0", "q2:1", "job-1", "job-2", "job-3"):
        store.publish_delta("t", spark.range(5), "id", run_id=run_id)
    store.vacuum("t", keep=2)
    rows = {(r.table, r.run_id) for r in spark.read.parquet(store.pointer_path).collect()}
    assert rows == {("other", "x"), ("t", "q1:0"), ("t", "q2:1"), ("t", "job-2"), ("t", "job-3")}
    assert store.published("t", "q2:1") and store.current("t").count() == 5 and store.current("other").count() == 3


def test_buckets_follow_the_key_and_the_size(spark, workdir):
    store = TableStore(spark, workdir, rows_per_bucket=10, min_buckets=2)
    store.publish("g", spark.createDataFrame([(i, i * 0.5) for i in range(20)], "id long, x double"), run_id="0", pk="id")
    assert store.state("g")["buckets"] == 2
    more = spark.createDataFrame([(i, i * 0.5) for i in range(100)], "id int, x double")
    store.publish_delta("g", more, "id", run_id="1")  # touches all buckets: they are cut smaller
    assert store.state("g")["buckets"] == 12 and store.current("g").count() == 100
    # Another key re-deals the rows; -0.0 is 0.0.
    store.publish_delta("g", spark.createDataFrame([(-1, -0.0)], "id long, x double"), "x", run_id="2")
    assert store.state("g")["pk"] == ["x"] and store.current("g").count() == 100
    assert [r.id for r in store.current("g").where("x = 0").collect()] == [-1]
    store.publish("g", spark.range(0), run_id="3", pk="id")
    assert store.current("g").count() == 0 and store.current("g").columns == ["id"]
    store.publish_delta("g", spark.range(3), "id", run_id="4")
    assert store.current("g").count() == 3


def test_all_rows_rejected_fails_verification_before_swap(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", contract=[Field("id", "long"), Field("nome", "string")])
    sync_table(spark, spec, _source(spark), state)
    before = _table(state, "t")
    bad = [(9, None, "2024-02-01 00:00:00")]
    res = sync_table(spark, spec, _source(spark, bad), state)
    assert res.status == "failed" and "nothing would be loaded" in res.error
    assert _table(state, "t") == before


def test_cursor_comes_from_raw_rows_before_transform(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="full",
                    transform_sql="SELECT id, nome FROM {raw} WHERE id < 4")
    res = sync_table(spark, spec, _source(spark), state, client="c")
    # The transform dropped id 4, yet the cursor reflects it (raw rows), and the
    # expected count is the staged count after the transform.
    assert res.status == "success" and res.records_extracted == 4 and res.records_loaded == 3
    assert state.saved_cursor("c", "t") == "2024-01-03 10:00:00"


def test_selected_fields_and_dedupe_latest_per_key(spark, workdir):
    state = StateStore(spark, workdir)
    rows = [(1, "a", "2024-01-01 00:00:00"), (1, "b", "2024-01-02 00:00:00"), (2, "c", "2024-01-01 00:00:00")]
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="full", dedupe=True,
                    fields=("id", "nome", "ultima_atualizacao"))
    sync_table(spark, spec, _source(spark, rows), state)
    assert _table(state, "t") == [(1, "b", dt.datetime(2024, 1, 2)), (2, "c", dt.datetime(2024, 1, 1))]
    nodup = SyncSpec("u", pk="id", fields=("id", "nome"))
    sync_table(spark, nodup, _source(spark, rows), state)
    assert _table(state, "u") == [(1, "a"), (1, "b"), (2, "c")]


def test_clear_checkpoint_means_no_resume(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id")
    crashed = sync_table(spark, spec, _source(spark), state, fail_after="EXTRACT")
    assert state.last_checkpoint("default", "t")["stage"] == "EXTRACT"
    state.clear_checkpoint("default", "t")
    assert state.last_checkpoint("default", "t") is None
    fresh = sync_table(spark, spec, _source(spark), state, from_checkpoint=True)
    assert fresh.status == "success" and fresh.run_id != crashed.run_id


def test_incremental_without_cursor_starts_yesterday_in_source_zone(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="incremental")
    # 02:00 UTC on 4 Jan is 23:00 on 3 Jan in Sao Paulo: look back to 2 Jan 00:00.
    res = sync_table(spark, spec, _source(spark), state, client="c", now="2024-01-04 02:00:00")
    assert res.counts["since"] == "2024-01-02 00:00:00"
    assert res.records_extracted == 2 and [r[0] for r in _table(state, "t", "c")] == [2, 4]


def test_one_failing_table_never_stops_the_others(spark, workdir):
    from tablesync.plans.job import sync_all

    state = StateStore(spark, workdir)

    def broken(since):
        raise RuntimeError("boom at postgresql://a:b@c/d")

    results = sync_all(spark, [(SyncSpec("ok1", pk="id"), _source(spark)),
                               (SyncSpec("bad", pk="id"), broken),
                               (SyncSpec("ok2", pk="id"), _source(spark))], state, client="acme")
    assert [r.status for r in results] == ["success", "failed", "success"]
    payload = summary_payload("acme", results)
    assert payload["status"] == "failed" and "b@" not in payload["streams"][1]["error"]
    assert state.runs().where("status = 'FAILED'").count() == 1


def test_narrowing_can_be_switched_off(spark, workdir):
    state = StateStore(spark, workdir)
    sync_table(spark, SyncSpec("t", pk="id", narrow=False), _source(spark), state)
    assert dict(state.tables.current("t").dtypes)["ultima_atualizacao"] == "string"


def test_delta_with_values_that_do_not_fit_fails_before_publish(spark, workdir):
    state = StateStore(spark, workdir)
    full = SyncSpec("t", pk="id", mode="full", replication_key="ultima_atualizacao")
    sync_table(spark, full, _source(spark), state)
    assert dict(state.tables.current("t").dtypes)["ultima_atualizacao"] == "timestamp_ntz"
    before = _table(state, "t")
    delta = SyncSpec("t", pk="id", mode="incremental", replication_key="ultima_atualizacao")
    bad = [(5, "eva", "2024-02-01 00:00:00"), (6, "ivo", "2024-02-02 xx")]
    res = sync_table(spark, delta, _source(spark, bad), state)
    assert res.status == "failed" and "do not fit" in res.error
    assert _table(state, "t") == before
    good = [(5, "eva", "2024-02-01 00:00:00")]
    assert sync_table(spark, delta, _source(spark, good), state).status == "success"
    assert dict(state.tables.current("t").dtypes)["ultima_atualizacao"] == "timestamp_ntz"
    assert _table(state, "t")[-1] == (5, "eva", dt.datetime(2024, 2, 1))


def test_numeric_cursor_compares_numbers(spark, workdir):
    state = StateStore(spark, workdir)
    rows = [(1, "a", "9"), (2, "b", "10")]
    spec = SyncSpec("n", pk="id", replication_key="ultima_atualizacao", mode="full", numeric_cursor=True)
    sync_table(spark, spec, _source(spark, rows), state, client="c")
    assert state.saved_cursor("c", "n") == "10"
    inc = SyncSpec("n", pk="id", replication_key="ultima_atualizacao", mode="incremental", numeric_cursor=True)
    res = sync_table(spark, inc, _source(spark, rows + [(3, "c", "11")]), state, client="c")
    assert res.records_extracted == 2 and state.saved_cursor("c", "n") == "11"


def test_resumed_run_still_saves_the_cursor(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="full")
    crashed = sync_table(spark, spec, _source(spark), state, client="c", fail_after="EXTRACT")
    assert crashed.status == "failed" and state.saved_cursor("c", "t") is None
    resumed = sync_table(spark, spec, _source(spark), state, client="c", from_checkpoint=True)
    assert resumed.status == "success" and resumed.records_extracted == 4
    assert state.saved_cursor("c", "t") == "2024-01-03 10:00:00"


def test_a_finished_run_leaves_no_staged_files(spark, workdir):
    from tablesync.session import list_names

    state = StateStore(spark, workdir)
    done = sync_table(spark, SyncSpec("t", pk="id"), _source(spark), state)
    failed = sync_table(spark, SyncSpec("t", pk="id"), _source(spark), state, fail_after="LOAD")
    assert done.status == "success" and list_names(f"{workdir}/staging/default/t") == [f"run={failed.run_id}"]
    before = {r.run_id for r in spark.read.parquet(state.tables.pointer_path).collect()}
    resumed = sync_table(spark, SyncSpec("t", pk="id"), _source(spark), state, from_checkpoint=True)
    # What LOAD wrote is published, not written again.
    assert resumed.status == "success" and resumed.counts["loaded"] == 4
    assert {r.run_id for r in spark.read.parquet(state.tables.pointer_path).collect()} - before == {failed.run_id}
    assert list_names(f"{workdir}/staging/default/t") == []


def test_delta_without_its_key_is_refused_and_changes_nothing(spark, workdir):
    state = StateStore(spark, workdir)
    sync_table(spark, SyncSpec("t", pk="id", replication_key="ultima_atualizacao"), _source(spark), state)
    before = _table(state, "t")
    res = sync_table(spark, SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="incremental",
                                     fields=("nome", "ultima_atualizacao")),
                     _source(spark, [(9, "z", "2024-05-01 00:00:00")]), state)
    assert res.status == "failed" and "key columns" in res.error
    fresh = StateStore(spark, workdir)  # as in a later session
    assert _table(fresh, "t") == before


def test_clients_keep_tables_of_their_own(spark, workdir):
    state = StateStore(spark, workdir)
    for client, name in (("c0", "ana"), ("c1", "bia")):
        sync_table(spark, SyncSpec("t", pk="id"), _source(spark, [(1, name, "2024-01-01 00:00:00")]), state, client=client)
    assert [_table(state, "t", c)[0][1] for c in ("c0", "c1")] == ["ana", "bia"]
    assert spark.table("c0__t").first().nome == "ana" and spark.table("c1__t").first().nome == "bia"


def test_number_key_without_cursor_starts_from_the_first_row(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("n", pk="id", replication_key="id", mode="incremental")
    first = sync_table(spark, spec, _source(spark), state)
    assert first.status == "success" and first.records_extracted == 4 and state.saved_cursor("default", "n") == "4"
    more = ROWS + [(10, "x", "2024-01-09 00:00:00")]
    assert sync_table(spark, spec, _source(spark, more), state).records_extracted == 2
    assert state.saved_cursor("default", "n") == "10"


def test_dedupe_keeps_rows_without_a_key_or_a_time(spark, workdir):
    state = StateStore(spark, workdir)
    rows = [(None, "n1", "2024-01-01 00:00:00"), (None, "n2", "2024-01-02 00:00:00"),
            (1, "old", None), (1, "new", "2024-01-03 00:00:00"), (2, "only", "0000-00-00 00:00:00")]
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", dedupe=True)
    res = sync_table(spark, spec, _source(spark, rows), state)
    assert res.status == "success" and res.records_loaded == 4
    got = {(r.id, r.nome) for r in state.tables.current("t").collect()}
    assert got == {(None, "n1"), (None, "n2"), (1, "new"), (2, "only")}


def test_no_valid_row_keeps_the_staged_columns(spark, workdir):
    from tablesync.sources.files import staged_scan

    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", contract=[Field("id", "long"), Field("nome", "string")])
    res = sync_table(spark, spec, _source(spark, [(1, None, None)]), state)
    staged = staged_scan(spark, f"{workdir}/staging/default/t/run={res.run_id}/checked/_part=valid")
    assert res.status == "failed" and staged.count() == 0
    assert {"id": "bigint", "nome": "string"}.items() <= dict(staged.dtypes).items()


def test_resumed_run_files_each_dead_letter_once(spark, workdir, monkeypatch):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", contract=[Field("id", "long"), Field("nome", "string")])
    original = StateStore.checkpoint

    def lost(self, client, pipeline, run_id, stage, **kw):
        if stage == "VALIDATE":
            raise RuntimeError("driver lost before the checkpoint")
        return original(self, client, pipeline, run_id, stage, **kw)

    monkeypatch.setattr(StateStore, "checkpoint", lost)
    assert sync_table(spark, spec, _source(spark), state).status == "failed"
    monkeypatch.setattr(StateStore, "checkpoint", original)
    assert sync_table(spark, spec, _source(spark), state, from_checkpoint=True).status == "success"
    assert spark.read.parquet(state.path("dead_letters")).count() == 1


def test_job_strips_nul(spark, workdir):
    state = StateStore(spark, workdir)
    sync_table(spark, SyncSpec("t", pk="id"), _source(spark, [(1, "a\x00b", None)]), state)
    assert state.tables.current("t").first().nome == "ab"


def test_paths_are_asked_of_the_file_system_spark_uses(spark, workdir):
    from py4j.protocol import Py4JJavaError

    from tablesync.session import path_exists

    assert path_exists(workdir, spark) and path_exists(f"file://{workdir}", spark)
    assert not path_exists(f"{workdir}/none", spark)
    with pytest.raises(Py4JJavaError, match="nosuchfs"):
        path_exists("nosuchfs://bucket/x", spark)


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tablesync import session

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))


def test_restore_views_from_the_pointer_table(spark, workdir):
    store = TableStore(spark, workdir)
    store.publish("rv", spark.range(4), run_id="0")
    store.publish_delta("rv", spark.range(2, 6), "id", run_id="1")
    spark.catalog.dropTempView("rv")
    fresh = TableStore(spark, workdir)  # as in a new session: no cached state
    fresh.restore_views()
    assert sorted(r.id for r in spark.table("rv").collect()) == [0, 1, 2, 3, 4, 5]


def test_monitoring_queries_run_on_the_job_ledger(spark, workdir):
    from tablesync.operators import ledger

    state = StateStore(spark, workdir)
    ok = sync_table(spark, SyncSpec("a", pk="id"), _source(spark), state, client="acme")

    def broken(since):
        raise RuntimeError("down")

    sync_table(spark, SyncSpec("b", pk="id"), broken, state, client="acme")
    runs = state.runs()
    top = ledger.status_top(runs, client="acme").collect()
    assert [r.pipeline for r in top] == ["b", "a"] and top[0].status == "FAILED" and top[0].error == "down"
    assert top[1].stage == "VERIFY" and top[1].records_out == ok.records_loaded
    assert ledger.failed_on_day(runs).count() == 1
    assert {r.pipeline for r in ledger.volume_by_day(runs).collect()} == {"a"}
    summary = ledger.run_summary(runs, run_keys=("client",)).first()
    assert summary.status == "failed" and '"error":"down"' in summary.streams
    # Dead letters of the client's latest run, from the job's own tables.
    spec = SyncSpec("c", pk="id", contract=[Field("id", "long"), Field("nome", "string")])
    last = sync_table(spark, spec, _source(spark), state, client="acme")
    dead = spark.read.parquet(state.path("dead_letters"))
    latest = ledger.dead_letters_latest(dead, state.runs(), client="acme").collect()
    assert [r.run_id for r in latest] == [last.run_id] and latest[0].stream == "c"


# -------------------------------------------------------------- the ledger
def _ledger_files(workdir):
    from pathlib import Path

    return [str(p) for d in ("ledger", "ledger_snapshot", "ledger_folds")
            for p in Path(workdir, d).rglob("*.parquet")]


def _ledger_state(state):
    from tablesync.operators import ledger

    runs = {r.run_id: (r.client, r.pipeline, r.status, r.stage, r.records_out, r.error, r.started_at, r.finished_at)
            for r in state.runs().collect()}
    points = {tuple(r) for r in ledger.checkpoint_latest(state.checkpoints()).collect()}
    return runs, points, sorted(tuple(r) for r in state.events().collect()), state.saved_cursor("acme", "t")


def test_a_folded_ledger_says_the_same_in_few_files(spark, workdir):
    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="full")
    for n in range(3):
        sync_table(spark, spec, _source(spark), state, client="acme", fail_after="LOAD" if n == 1 else None)
    sync_table(spark, SyncSpec("u", pk="id"), _source(spark), state, client="acme", fail_after="EXTRACT")
    before = _ledger_state(StateStore(spark, workdir))
    assert len(before[0]) == 4 and len(_ledger_files(workdir)) > 12
    assert state.fold() > 12
    assert _ledger_state(StateStore(spark, workdir)) == before
    # One day: a file a kind, and the marker.
    assert len(_ledger_files(workdir)) <= 5 and state.fold() == 0
    # A tail on top, a run that began before the fold goes on, and folds again.
    done = sync_table(spark, SyncSpec("u", pk="id"), _source(spark), state, client="acme", from_checkpoint=True)
    assert done.status == "success" and state.runs().where(F.col("run_id") == done.run_id).first().status == "SUCCESS"
    sync_table(spark, spec, _source(spark), state, client="acme")
    before = _ledger_state(StateStore(spark, workdir))
    assert len(before[0]) == 5
    state.fold()
    assert _ledger_state(StateStore(spark, workdir)) == before and len(_ledger_files(workdir)) <= 5


@pytest.mark.parametrize("lost_at", ["marker", "deletions"])
def test_a_fold_cut_off_changes_nothing(spark, workdir, monkeypatch, lost_at):
    from tablesync.plans import snapshot

    state = StateStore(spark, workdir)
    spec = SyncSpec("t", pk="id", replication_key="ultima_atualizacao", mode="full")
    sync_table(spark, spec, _source(spark), state, client="acme")
    state.fold()
    sync_table(spark, spec, _source(spark), state, client="acme", fail_after="LOAD")
    before = _ledger_state(StateStore(spark, workdir))

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(snapshot.time if lost_at == "marker" else snapshot, "time_ns" if lost_at == "marker" else "delete_path", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            state.fold()
    assert _ledger_state(StateStore(spark, workdir)) == before
    again = StateStore(spark, workdir)
    again.fold()
    assert _ledger_state(StateStore(spark, workdir)) == before and again.fold() == 0
    resumed = sync_table(spark, spec, _source(spark), again, client="acme", from_checkpoint=True)
    assert resumed.status == "success" and len(again.runs().collect()) == 2
