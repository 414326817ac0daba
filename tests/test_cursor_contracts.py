"""Cursor rules and row contracts."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tablesync.functions.clean import sanitize
from tablesync.operators import contracts as ct
from tablesync.operators.contracts import Field
from tablesync.operators.cursor import advance, cursor_max, default_lookback, delta_filter


def _advance(spark, current, candidate):
    df = spark.createDataFrame([(candidate,)], "c string")
    return df.select(advance(current, F.nullif(F.col("c"), F.lit("")))).first()[0]


STAMPS = st.one_of(st.none(), st.just(""), st.datetimes(
    min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2090, 1, 1)).map(lambda d: d.strftime("%Y-%m-%d %H:%M:%S")))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(current=st.one_of(st.none(), STAMPS.filter(bool)), seen=st.lists(STAMPS, max_size=6))
def test_cursor_is_the_greatest_value_and_never_goes_back(spark, current, seen):
    df = spark.createDataFrame([(x,) for x in seen], "c string")
    got = cursor_max(df, "c", current=current).first()["cursor"]
    known = [x for x in [current, *seen] if x]
    assert got == (max(known) if known else None)


def test_advance_keeps_the_saved_cursor_without_a_candidate(spark):
    assert _advance(spark, "2019-07-04 08:15:30", None) == "2019-07-04 08:15:30"


def test_cursor_max_ignores_blank_and_compares_numbers_numerically(spark):
    df = spark.createDataFrame([("a", "9"), ("a", "10"), ("a", ""), ("a", None)], "g string, k string")
    assert cursor_max(df, "k", ["g"]).first()["cursor"] == "9"
    assert cursor_max(df, "k", ["g"], numeric=True).first()["cursor"] == "10"


def test_delta_filter_is_inclusive(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "u string")
    assert delta_filter(df, "u", "2024-01-02 00:00:00").count() == 1
    assert delta_filter(df, "u", None).count() == 2


def test_numeric_filter_keeps_large_keys_apart(spark):
    big = 2**53
    df = spark.createDataFrame([(str(big),), (str(big + 1),), ("7",)], "k string")
    assert [r.k for r in delta_filter(df, "k", str(big + 1), numeric=True).collect()] == [str(big + 1)]


def test_default_lookback_is_yesterday_midnight_in_source_zone(spark):
    df = spark.createDataFrame([("2024-03-15 02:00:00",), ("2024-03-15 04:00:00",)], "now string")
    df = df.withColumn("now", F.to_timestamp_ntz("now"))
    got = [r[0] for r in df.select(default_lookback("now")).collect()]
    # 02:00 UTC is still 14 March in Sao Paulo (UTC-3).
    assert got == ["2024-03-13 00:00:00", "2024-03-14 00:00:00"]


SENSOR = [Field("sensor", "int"), Field("place", "string")]


def test_contract_splits_invalid_rows(spark):
    rows = [("40", "roof"), ("4O", "cellar"), ("41", "garden"), ("42", "  ")]
    ann = ct.annotate(sanitize(spark.createDataFrame(rows, "sensor string, place string")), SENSOR)
    assert sorted(tuple(r) for r in ct.valid_rows(ann, SENSOR).collect()) == [(40, "roof"), (41, "garden")]
    dead = {r.record: r for r in ct.dead_letters(ann, 31, "sensors").collect()}
    letter = next(r for k, r in dead.items() if "4O" in k)
    assert len(dead) == 2 and letter.run_id == 31 and '"type":"int_parsing"' in letter.errors


def test_zoned_timestamps_become_utc_wall_clock(spark):
    contract = [Field("at", "timestamp")]
    rows = [("2021-03-04T05:06:07Z",), ("2021-03-04 05:06:07.5+02:00",), ("2021-03-04T05:06-0330",), ("2021-03-04T05:06X",)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            ann = ct.annotate(spark.createDataFrame(rows, "at string"), contract)
            got = sorted(str(r.at) for r in ct.valid_rows(ann, contract).collect())
            assert got == ["2021-03-04 03:06:07.500000", "2021-03-04 05:06:07", "2021-03-04 08:36:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_required_string_rejects_null_and_default_fills_absent(spark):
    contract = [Field("id", "long"), Field("email", "string"), Field("status", "string", default="A"),
                Field("obs", "string", nullable=True)]
    df = spark.createDataFrame([(1, None, None), (2, "a@b", "x")], "id long, email string, obs string")
    ann = ct.annotate(df, contract)
    valid = [tuple(r) for r in ct.valid_rows(ann, contract).collect()]
    assert valid == [(2, "a@b", "A", "x")]
    err = ct.invalid_rows(ann).select(ct.errors_json()).first()[0]
    assert '"type":"string_type"' in err and '"input":null' in err


def test_missing_required_column(spark):
    df = spark.createDataFrame([(1,)], "id long")
    ann = ct.annotate(df, [Field("id", "long"), Field("email", "string")])
    assert ann.where("_valid").count() == 0
    assert '"type":"missing"' in ann.select(ct.errors_json()).first()[0]


def test_coercions(spark):
    contract = [Field("i", "int"), Field("d", "double"), Field("b", "boolean"), Field("dt", "date"),
                Field("ts", "timestamp")]
    df = spark.createDataFrame([(" 12 ", "1e3", "yes", "2024-02-29", "2024-02-29 10:00:00"),
                                ("1.5", "x", "maybe", "2024-02-30", "nope")],
                               "i string, d string, b string, dt string, ts string")
    ann = ct.annotate(df, contract)
    good = ct.valid_rows(ann, contract).first()
    assert (good.i, good.d, good.b, str(good.dt)) == (12, 1000.0, True, "2024-02-29")
    bad = ann.where(~F.col("_valid")).select(F.transform("_errors", lambda e: e["type"])).first()[0]
    assert bad == ["int_parsing", "float_parsing", "bool_parsing", "date_parsing", "datetime_parsing"]


def test_empty_batch_and_no_contract(spark):
    df = spark.createDataFrame([], "sensor string, place string")
    ann = ct.annotate(df, SENSOR)
    assert ann.count() == 0
    valid, ann2 = ct.validate(df, None)
    assert valid is df and ann2 is None


NESTED = [
    Field("id", "long"),
    Field("dono", "struct", nullable=True, fields=[
        Field("nome", "string"), Field("idade", "int", nullable=True), Field("uf", "string", default="SP"),
        Field("casa", "struct", nullable=True, fields=[Field("cep", "int")])]),
    Field("notas", "list", item=Field("nota", "double")),
    Field("pares", "list", default=[], item=Field("par", "list", item=Field("n", "int"))),
    Field("mapa", "map", nullable=True, item=Field("valor", "int")),
]
NESTED_DDL = ("id string, dono struct<nome:string,idade:string,casa:struct<cep:string,rua:string>,sobra:int>, "
              "notas array<string>, pares array<array<string>>, mapa map<string,string>")


def _nested(spark, rows, ddl=NESTED_DDL, contract=NESTED):
    ann = ct.annotate(spark.createDataFrame(rows, ddl), contract)
    return ann, {r.id: [(list(e.loc), e.type, e.input) for e in r._errors] for r in ann.collect()}


def test_nested_values_are_coerced_at_every_depth(spark):
    rows = [("1", ("ana", " 30 ", ("01000", "r"), 1), ["1", "2.5"], [["1", "2"], []], {"a": "1", "b": "+2"}),
            ("2", ("bia", None, None, None), [], [], {}), ("3", None, ["0"], [[]], None)]
    ann, errors = _nested(spark, rows)
    assert errors == {"1": [], "2": [], "3": []}
    out = ct.valid_rows(ann, NESTED)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [f.spark_type.simpleString() for f in NESTED]
    got = {r.id: r.asDict(recursive=True) for r in out.collect()}
    assert got[1] == {"id": 1, "dono": {"nome": "ana", "idade": 30, "uf": "SP", "casa": {"cep": 1000}},
                      "notas": [1.0, 2.5], "pares": [[1, 2], []], "mapa": {"a": 1, "b": 2}}
    assert got[2]["dono"] == {"nome": "bia", "idade": None, "uf": "SP", "casa": None} and got[2]["mapa"] == {}
    assert got[3]["dono"] is None and got[3]["mapa"] is None


def test_nested_errors_name_their_path(spark):
    rows = [("x", (None, "3.5", ("?", None), 1), ["1", None, "z"], [["1"], ["q", None]], {"a": "1", "b": "two", "c": None})]
    _, errors = _nested(spark, rows)
    assert errors["x"] == [
        (["id"], "int_parsing", "x"), (["dono", "nome"], "string_type", None), (["dono", "idade"], "int_parsing", "3.5"),
        (["dono", "casa", "cep"], "int_parsing", "?"), (["notas", "1"], "float_type", None),
        (["notas", "2"], "float_parsing", "z"), (["pares", "1", "0"], "int_parsing", "q"),
        (["pares", "1", "1"], "int_type", None), (["mapa", "b"], "int_parsing", "two"), (["mapa", "c"], "int_type", None)]


def test_nested_fields_of_another_shape_or_absent(spark):
    ann, errors = _nested(spark, [("1", "text", (["a"],), ("1", None))],
                          "id string, dono string, notas struct<x:array<string>>, mapa struct<k:string,z:string>")
    assert errors["1"] == [(["dono"], "model_type", "text"), (["notas"], "list_type", '{"x":["a"]}')]
    only = [NESTED[0], NESTED[3], NESTED[4], Field("falta", "struct", fields=[Field("a", "int")])]
    ann, errors = _nested(spark, [("1", ("7", None))], "id string, mapa struct<k:string,z:string>", only)
    # A list with a default; a JSON object as a map, its absent key no entry; a struct that is required.
    assert errors["1"] == [(["falta"], "missing", None)]
    row = ann.select("`_v_pares`", "`_v_mapa`").first()
    assert row[0] == [] and row[1] == {"k": 7}
    with pytest.raises(ValueError):
        Field("a", "struct")
    with pytest.raises(ValueError):
        Field("a", "int", item=Field("b", "int"))


def test_nested_contract_in_the_job(spark, workdir):
    from tablesync.plans.job import StateStore, SyncSpec, sync_table

    rows = [("1", ("ana", None, None, None), ["1"], [], {}), ("2", ("bia", "x", None, None), ["1"], [], {})]
    state = StateStore(spark, workdir)
    spec = SyncSpec("n", pk="id", contract=NESTED)
    res = sync_table(spark, spec, lambda since: spark.createDataFrame(rows, NESTED_DDL), state)
    assert res.status == "success" and res.records_loaded == 1
    assert state.tables.current("n").first().dono.nome == "ana"
    dead = spark.read.parquet(state.path("dead_letters")).first()
    assert '"loc":["dono","idade"]' in dead.errors and '"bia"' in dead.record
