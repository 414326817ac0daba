"""Delta upsert semantics, schema evolution and plan shape."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.types import added_column_type, narrow_types
from tablesync.operators.upsert import delta_upsert, full_refresh


def test_new_columns_follow_the_target_in_staging_order(spark):
    target = spark.createDataFrame([("x1", 3)], "sku string, stock int")
    staged = spark.createDataFrame([(True, "x2", 1.5)], "fragile boolean, sku string, weight double")
    out = delta_upsert(target, staged, "sku")
    assert out.columns == ["sku", "stock", "fragile", "weight"]
    assert sorted(tuple(r) for r in out.collect()) == [("x1", 3, None, None), ("x2", None, True, 1.5)]


@pytest.mark.parametrize("ddl,added", [
    ("tinyint", "bigint"), ("int", "bigint"), ("bigint", "bigint"), ("float", "double"), ("decimal(9,4)", "double"),
    ("boolean", "boolean"), ("date", "date"), ("timestamp", "timestamp"), ("array<int>", "string"),
    ("map<string,int>", "string"), ("binary", "string"), ("string", "string")])
def test_type_of_an_added_column(ddl, added):
    column = T.DataType.fromDDL(f"c {ddl}").fields[0].dataType
    assert added_column_type(column).simpleString() == added


def _rows(df, order=("id",)):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_delete_then_insert_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, nome string")
    staged = spark.createDataFrame([(2, "B"), (4, "D")], "id long, nome string")
    out = delta_upsert(target, staged, "id")
    assert _rows(out) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_duplicate_staged_keys_all_inserted(spark):
    target = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b")], "id long, nome string")
    staged = spark.createDataFrame([(1, "x"), (1, "y")], "id long, nome string")
    assert _rows(delta_upsert(target, staged, "id")) == [(1, "x"), (1, "y"), (2, "b")]


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t"), (1, "a")], "id long, nome string")
    staged = spark.createDataFrame([(None, "s"), (1, "b")], "id long, nome string")
    assert _rows(delta_upsert(target, staged, "id")) == [(1, "b"), (None, "s"), (None, "t")]


def test_schema_evolution_adds_columns_with_mapped_types(spark):
    target = spark.createDataFrame([(1, "a")], "id long, nome string")
    staged = spark.createDataFrame([(1, "b", 7, "1.25", (5,))],
                                   "id long, nome string, n int, v string, s struct<x:int>")
    staged = staged.withColumn("v", F.col("v").cast("decimal(10,2)"))
    out = delta_upsert(target, staged, "id")
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["n"] == T.LongType() and types["v"] == T.DoubleType() and types["s"] == T.StringType()
    assert out.columns == ["id", "nome", "n", "v", "s"]
    assert [tuple(r) for r in out.collect()] == [(1, "b", 7, 1.25, '{"x":5}')]


def test_target_only_columns_null_for_new_rows(spark):
    target = spark.createDataFrame([(1, "a", "old")], "id long, nome string, legado string")
    staged = spark.createDataFrame([(2, "b")], "id long, nome string")
    assert _rows(delta_upsert(target, staged, "id")) == [(1, "a", "old"), (2, "b", None)]


def test_first_run_and_full_refresh(spark):
    staged = spark.createDataFrame([(1, "a")], "id long, nome string")
    assert delta_upsert(None, staged, "id").collect() == staged.collect()
    assert full_refresh(staged) is staged


def test_applying_same_delta_twice_is_idempotent(spark):
    target = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id long, nome string")
    staged = spark.createDataFrame([(i, f"s{i}") for i in range(10, 30, 2)], "id long, nome string")
    once = delta_upsert(target, staged, "id")
    twice = delta_upsert(once, staged, "id")
    assert _rows(once) == _rows(twice)


def test_composite_key(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "a long, b long, v string")
    staged = spark.createDataFrame([(1, 2, "B")], "a long, b long, v string")
    assert _rows(delta_upsert(target, staged, ["a", "b"])) == [(1, 1, "a"), (1, 2, "B")]


def test_bounded_delta_is_broadcast(spark):
    target = spark.range(1000).withColumnRenamed("id", "k")
    staged = spark.range(10).withColumnRenamed("id", "k")
    plan = delta_upsert(target, staged, "k", staged_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_narrow_types_dates_and_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-02 10:00:00", "x", None),
                                (None, "2024-01-03 11:00:00", "2024-01-01", None)],
                               "d string, t string, m string, n string")
    types = {f.name: f.dataType for f in narrow_types(df).schema.fields}
    assert types == {"d": T.DateType(), "t": T.TimestampNTZType(), "m": T.StringType(), "n": T.StringType()}


def test_narrow_types_inside_structs_arrays_and_maps(spark):
    import datetime as dt

    from tablesync.functions.types import narrow_plan

    ddl = ("a struct<d:string,x:string,n:int>, b array<struct<t:string,s:array<string>>>, c map<string,string>, "
           "e array<string>, `f.g` struct<d:string>, h array<string>")
    rows = [(("2024-01-02", "2024-01-02", 1), [("2024-01-02 10:00:00", ["2024-01-01", None]), (None, None)],
             {"k": "2024-05-05"}, [], ("2024-01-09",), ["2024-01-02", "no"]),
            (None, None, None, None, None, None),
            (("2024-02-02", "other", None), [], {}, [None], None, ["2024-01-02"])]
    df = spark.createDataFrame(rows, ddl)
    assert narrow_plan(df) == {("a", "d"): "date", ("b", "[]", "t"): "timestamp_ntz", ("b", "[]", "s", "[]"): "date",
                               ("c", "{}"): "date", ("f.g", "d"): "date"}
    out = narrow_types(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "struct<d:date,x:string,n:int>", "array<struct<t:timestamp_ntz,s:array<date>>>", "map<string,date>",
        "array<string>", "struct<d:date>", "array<string>"]
    got = [r.asDict(recursive=True) for r in out.collect()]
    assert got[0]["b"] == [{"t": dt.datetime(2024, 1, 2, 10), "s": [dt.date(2024, 1, 1), None]}, {"t": None, "s": None}]
    assert got[1] == dict.fromkeys(got[1]) and got[2]["a"] == {"d": dt.date(2024, 2, 2), "x": "other", "n": None}


def test_a_delta_follows_the_nested_types_of_its_table(spark, workdir):
    from tablesync.plans.job import StateStore, SyncSpec, sync_table

    ddl = "id long, at string, m struct<d:string>"
    state = StateStore(spark, workdir)
    full = SyncSpec("t", pk="id", replication_key="at")
    first = [(1, "2024-01-01 00:00:00", ("2024-01-01",)), (2, "2024-01-02 00:00:00", ("text",))]
    sync_table(spark, full, lambda since: spark.createDataFrame(first, ddl), state)
    later = [(3, "2024-01-03 00:00:00", ("2024-01-03",))]
    delta = SyncSpec("t", pk="id", replication_key="at", mode="incremental")
    res = sync_table(spark, delta, lambda since: spark.createDataFrame(later, ddl), state)
    assert res.status == "success", res.error
    assert sorted(r.m.d for r in state.tables.current("t").collect()) == ["2024-01-01", "2024-01-03", "text"]


def test_shuffled_path_salts_hot_and_null_keys(spark):
    n = 30000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7))
        .otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    staged = spark.range(0, n, 2).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    # No size figures: the shuffled, salted path.
    salted = delta_upsert(target, staged, "k")
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "LeftAnti" in plan
    broadcast = delta_upsert(target, staged, "k", staged_rows=n // 2)
    assert _rows(salted) == _rows(broadcast)
    assert salted.count() == 10000 + 10000 + 5000 + 15000
    # The hot key and the NULL keys are spread over the salts.
    from tablesync.operators.upsert import DEFAULT_SALT_BUCKETS
    sizes = (target.withColumn("_salt", F.pmod(F.xxhash64("k", "v"), F.lit(DEFAULT_SALT_BUCKETS)))
             .where(F.col("k").isNull() | (F.col("k") == 7)).groupBy("k", "_salt").count().collect())
    assert len(sizes) == 2 * DEFAULT_SALT_BUCKETS and max(r["count"] for r in sizes) < 10000 / 8
