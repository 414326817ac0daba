"""Streaming upsert equals the batch upsert; every registered query matches its
DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from tablesync.operators.upsert import delta_upsert
from tablesync.plans.publish import TableStore
from tablesync.streaming.upsert_stream import run_stream_upsert
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_stream_upsert_equals_batch_and_replay_is_noop(spark, workdir):
    base = spark.createDataFrame([(i, f"a{i}") for i in range(30)], "id long, v string")
    delta = spark.createDataFrame([(i, f"b{i}") for i in range(20, 40)], "id long, v string")
    base.repartition(2).write.parquet(f"{workdir}/in/1")
    delta.repartition(2).write.parquet(f"{workdir}/in/2")
    store = TableStore(spark, f"{workdir}/tables")
    run_stream_upsert(spark, f"{workdir}/in/*", "id long, v string", "s", "id", store,
                      checkpoint=f"{workdir}/cp", files_per_batch=1)
    got = sorted(tuple(r) for r in store.current("s").collect())
    assert got == sorted(tuple(r) for r in delta_upsert(base, delta, "id").collect())
    gens = spark.read.parquet(store.pointer_path).count()
    # A second start finds nothing new.
    run_stream_upsert(spark, f"{workdir}/in/*", "id long, v string", "s", "id", store,
                      checkpoint=f"{workdir}/cp", files_per_batch=1)
    assert spark.read.parquet(store.pointer_path).count() == gens
    assert sorted(tuple(r) for r in store.current("s").collect()) == got


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "o_channel" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[key])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows) == digest(rel.columns, d_rows)


def test_every_sync_query_has_an_oracle():
    from tablesync import oracle, registry

    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_replayed_batch_is_skipped(spark, workdir):
    from tablesync.streaming.upsert_stream import make_batch_upsert

    store = TableStore(spark, f"{workdir}/t")
    apply = make_batch_upsert(spark, "r", "id", store, query_id="q")
    b0 = spark.createDataFrame([(1, "a"), (None, "n")], "id long, v string")
    b1 = spark.createDataFrame([(2, "B"), (None, "m")], "id long, v string")
    apply(b0, 0)
    apply(b1, 1)
    # A writer started again replays its last batch: keys without a value are
    # not added twice, and no published folder is written again.
    folders = store.state("r", refresh=True)["folders"]
    make_batch_upsert(spark, "r", "id", TableStore(spark, f"{workdir}/t"), query_id="q")(b1, 1)
    assert store.state("r", refresh=True)["folders"] == folders
    assert sorted(tuple(r) for r in store.current("r").collect() if r.id) == [(1, "a"), (2, "B")]
    assert store.current("r").count() == 4


def test_a_second_checkpoint_folder_is_a_stream_of_its_own(spark, workdir):
    for n, rows in (("1", [(1, "a"), (2, "b")]), ("2", [(2, "c"), (3, "d")])):
        spark.createDataFrame(rows, "id long, v string").coalesce(1).write.parquet(f"{workdir}/in{n}")
    store = TableStore(spark, f"{workdir}/tables")
    for n in ("1", "2"):
        run_stream_upsert(spark, f"{workdir}/in{n}", "id long, v string", "two", "id", store,
                          checkpoint=f"{workdir}/cp{n}")
    assert sorted(tuple(r) for r in store.current("two").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_stream_strips_nul(spark, workdir):
    from tablesync.streaming.upsert_stream import make_batch_upsert

    store = TableStore(spark, f"{workdir}/t")
    make_batch_upsert(spark, "z", "id", store, query_id="q")(
        spark.createDataFrame([(1, "a\x00b")], "id long, v string"), 0)
    assert store.current("z").first().v == "ab"
