"""Derived test tables (FIXTURES.md, FX-n), built from the given parquet tables.

Every fixture is a lazy DataFrame over the whole input table, so the work of a
query grows with the table.  The matching DuckDB text lives in
``tablesync/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss"

# Fixed values used to split the FX-2 / FX-3 tables into base and delta.
FX2_BASE_BEFORE = "2000-01-01 00:00:00"
FX2_DELTA_FROM = "1999-07-01 00:00:00"
FX3_SPLIT = "2000-01-01 00:00:00"
FX3_NULL_SPLIT = "2001-10-25 00:00:00"
PAGE_SIZE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _pad2(c):
    return F.lpad(c.cast("string"), 2, "0")


def dirty_records(events: DataFrame, with_stream: bool = False, with_created: bool = False) -> DataFrame:
    """FX-1: API-like text records with blanks and impossible dates."""
    eid = F.col("event_id")
    nome = (F.when(eid % 7 == 0, F.lit(""))
             .when(eid % 7 == 1, F.lit("   "))
             .when(eid % 7 == 2, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
             .otherwise(F.col("event_type")))
    data_ref = (F.when(eid % 5 == 0, F.lit("0000-00-00"))
                 .when(eid % 5 == 1, F.concat(F.lit("2024-"), _pad2(eid % 14), F.lit("-"), _pad2(eid % 33)))
                 .when(eid % 5 == 2, F.concat(F.lit("2023-02-"), _pad2(eid % 31), F.lit(" 10:30:00")))
                 .when(eid % 5 == 3, F.concat(F.lit("ref "), eid.cast("string")))
                 .otherwise(F.lit("")))
    qtd = (F.when(eid % 11 == 0, F.lit("xx"))
            .when(eid % 11 == 1, F.lit(None).cast("string"))
            .otherwise((eid % 50).cast("string")))
    cols = [eid.alias("id"), nome.alias("nome"), data_ref.alias("data_ref"), qtd.alias("qtd"),
            F.date_format("ts", TS_TEXT).alias("ultima_atualizacao")]
    if with_stream:
        cols.append(F.col("event_type").alias("stream"))
    if with_created:
        cols.append(F.col("ts").alias("created_at"))
    return events.select(*cols)


def orders_base(orders: DataFrame) -> DataFrame:
    """FX-2 target: orders before 2000."""
    return (orders.where(F.col("o_orderdate") < _ntz(FX2_BASE_BEFORE))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


def orders_delta(orders: DataFrame) -> DataFrame:
    """FX-2 staging: orders from mid-1999, price changed, one new column."""
    return (orders.where(F.col("o_orderdate") >= _ntz(FX2_DELTA_FROM))
            .select("o_orderkey", "o_custkey", "o_orderstatus",
                    (F.col("o_totalprice") + 1000).alias("o_totalprice"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit("web")).otherwise(F.lit("loja"))
                    .alias("o_channel")))


def orders_delta_wide(orders: DataFrame) -> DataFrame:
    """FX-2 staging with added columns of several types (schema evolution)."""
    return (orders.where(F.col("o_orderdate") >= _ntz(FX2_DELTA_FROM))
            .select("o_orderkey", "o_custkey", "o_orderstatus",
                    (F.col("o_totalprice") + 1000).alias("o_totalprice"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit("web")).otherwise(F.lit("loja"))
                    .alias("o_channel"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("o_priority_rank"),
                    (F.col("o_custkey") % 1000 / 8).cast("decimal(18,3)").alias("o_discount"),
                    (F.col("o_orderstatus") == "O").alias("o_is_open"),
                    F.to_date("o_orderdate").alias("o_day"),
                    F.struct(F.col("o_custkey").alias("cust"),
                             F.col("o_orderpriority").alias("prio")).alias("o_meta")))


def orders_base_wide(orders: DataFrame) -> DataFrame:
    """FX-2 target that has a column the staging lacks (o_orderpriority)."""
    return (orders.where(F.col("o_orderdate") < _ntz(FX2_BASE_BEFORE))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))


def lineitem_split(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FX-3: duplicate keys (pk l_orderkey)."""
    cols = ["l_orderkey", "l_linenumber", "l_quantity"]
    split = _ntz(FX3_SPLIT)
    return (lineitem.where(F.col("l_shipdate") < split).select(*cols),
            lineitem.where(F.col("l_shipdate") >= split).select(*cols))


def lineitem_null_split(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FX-3 NULL keys: pk = nullif(l_orderkey % 10, 0)."""
    split = _ntz(FX3_NULL_SPLIT)
    shaped = lineitem.select(
        F.nullif(F.col("l_orderkey") % 10, F.lit(0)).alias("k"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    cols = ["k", "l_orderkey", "l_linenumber", "l_quantity"]
    return (shaped.where(F.col("l_shipdate") < split).select(*cols),
            shaped.where(F.col("l_shipdate") >= split).select(*cols))


def run_ledger(orders: DataFrame) -> DataFrame:
    """FX-4: one run per order, with the columns of the job's own ledger."""
    status = F.col("o_orderstatus")
    stages = F.array(*[F.lit(s) for s in ("EXTRACT", "VALIDATE", "LOAD", "VERIFY")])
    return orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string")).alias("client"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("clientes"))
         .when(F.col("o_orderkey") % 3 == 1, F.lit("contratos"))
         .otherwise(F.lit("titulos")).alias("pipeline"),
        F.when(F.col("o_orderstatus") == "F", F.lit("FAILED"))
         .when(F.col("o_orderstatus") == "O", F.lit("SUCCESS"))
         .otherwise(F.lit("RUNNING")).alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.floor("o_totalprice").cast("long").alias("records_out"),
        F.when(status == "F", F.get(stages, (F.col("o_orderkey") % 4).cast("int")))
         .when(status == "O", F.lit("VERIFY")).otherwise(F.lit("EXTRACT")).alias("stage"),
        F.when(status.isin("F", "O"), (F.floor("o_totalprice").cast("long") % 3600).cast("double"))
         .alias("duration_s"),
        F.when(status == "F", F.concat(F.lit("erro "), F.col("o_orderkey").cast("string"))).alias("error"),
    )


def secrets_text(customer: DataFrame) -> DataFrame:
    """FX-6: error messages that carry a DSN password."""
    return customer.select(
        "c_custkey",
        F.concat(F.lit("erro postgresql://u:"), F.col("c_name"), F.lit("@h:5432/db")).alias("message"))


def total_texts(events: DataFrame) -> DataFrame:
    """FX-7: page totals as text, in every shape the parser must handle."""
    eid = F.col("event_id")
    e, u = eid.cast("string"), F.col("user_id").cast("string")
    k = eid % 12
    raw = (F.when(k == 0, e)
            .when(k == 1, F.concat(e, F.lit(".0")))
            .when(k == 2, F.lit(""))
            .when(k == 3, F.concat(F.lit("-"), e))
            .when(k == 4, F.lit("abc"))
            .when(k == 5, F.lit("-0.5"))
            .when(k == 6, F.concat(F.lit(" "), u, F.lit(" ")))
            .when(k == 7, F.lit("NaN"))
            .when(k == 8, F.lit("inf"))
            .when(k == 9, F.concat(u, F.lit("d")))
            .when(k == 10, F.concat((eid % 10).cast("string"), F.lit("e3")))
            .otherwise(F.concat((eid % 100).cast("string"), F.lit(".9"))))
    return events.select(eid.alias("event_id"), raw.alias("total_raw"))


def batch_ledger(events: DataFrame) -> DataFrame:
    """FX-8: runs of ten consecutive events each (run_id = event_id div 10)."""
    run = F.floor(F.col("event_id") / 10).cast("long")
    return (events.groupBy(run.alias("run_id"))
            .agg(F.min("ts").alias("started_at"))
            .select("run_id", F.concat(F.lit("c"), (F.col("run_id") % 5).cast("string")).alias("client"),
                    "started_at"))


def later_records(events: DataFrame) -> DataFrame:
    """FX-9: the FX-1 source some time after the first run: every fourth record
    changed (every eighth into one the contract rejects), and new records."""
    moved = F.col("ts") + F.expr("INTERVAL 400 DAYS")
    eid = F.col("event_id")
    now = dirty_records(events.withColumn("ts", F.when(eid % 4 == 0, moved).otherwise(F.col("ts"))))
    now = (now.withColumn("qtd", F.when(F.col("id") % 4 == 0, F.lit("77")).otherwise(F.col("qtd")))
           .withColumn("nome", F.when(F.col("id") % 8 == 0, F.lit("")).otherwise(F.col("nome"))))
    new = dirty_records(events.where(eid % 10 == 3).withColumn("ts", moved))
    return now.unionByName(new.withColumn("id", F.col("id") + 1_000_000_000))


def later_events(events: DataFrame) -> DataFrame:
    """FX-10: the events some time later: every fourth changed, some new."""
    moved = F.col("ts") + F.expr("INTERVAL 400 DAYS")
    hit = F.col("event_id") % 4 == 0
    now = (events.withColumn("ts", F.when(hit, moved).otherwise(F.col("ts")))
           .withColumn("value", F.when(hit, F.col("value") + 1).otherwise(F.col("value"))))
    new = (events.where(F.col("event_id") % 10 == 3).withColumn("ts", moved)
           .withColumn("event_id", F.col("event_id") + 1_000_000_000))
    return now.unionByName(new)


def orders_first(orders: DataFrame) -> DataFrame:
    """FX-2 staging over all orders (a first delta run)."""
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                         (F.col("o_totalprice") + 1000).alias("o_totalprice"))


def timed_pages(events: DataFrame, page_size: int) -> DataFrame:
    """FX-12: the events of a type as pages, oldest first; a page is fetched
    when its latest event happens."""
    records = events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_type")
    pages = page_bodies(records, F.col("event_type"), "event_id", page_size, descending=False)
    times = F.transform(F.from_json("body", "registros array<struct<ts:string>>")["registros"], lambda r: r["ts"])
    return pages.withColumn("fetched_at", F.array_max(times).cast("timestamp_ntz"))


def nested_records(events: DataFrame) -> DataFrame:
    """FX-14: records with a struct, a list of structs and a map, some of them
    rejected at every depth."""
    eid = F.col("event_id")
    text = eid.cast("string")
    client = F.struct(
        F.when(eid % 9 == 0, F.concat(F.lit("x"), text)).otherwise((eid % 100).cast("string")).alias("codigo"),
        F.when(eid % 8 != 0, F.col("event_type")).alias("nome"), text.alias("extra"))

    def item(i):
        at = eid + i
        amount = F.when(at % 11 == 0, F.lit("muitos")).when(at % 13 != 0, (at % 50).cast("string"))
        return F.struct(F.concat(F.lit("s"), i.cast("string")).alias("sku"), amount.alias("qtd"))

    items = F.when(eid % 4 == 0, F.array().cast("array<struct<sku:string,qtd:string>>")).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), eid % 4 - 1), item))
    tags = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("u"),
                        F.when(eid % 23 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string")))
    return events.select(eid.alias("id"), F.when(eid % 19 != 0, client).alias("cliente"), items.alias("itens"),
                         tags.alias("tags"))


def nested_text(events: DataFrame) -> DataFrame:
    """FX-15: staged JSON whose text leaves hold dates and times at several
    depths, and one that mixes them with other text."""
    day, time = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", TS_TEXT)
    eid = F.col("event_id")
    meta = F.struct(day.alias("criado"), F.when(eid % 7 == 0, F.lit("n/d")).otherwise(day).alias("nota"))
    visits = F.when(eid % 3 != 0, F.array(F.struct(time.alias("em"), F.col("user_id").alias("quem")),
                                          F.struct(F.lit(None).cast("string").alias("em"), eid.alias("quem"))))
    return events.select(eid.alias("id"), F.when(eid % 5 != 0, meta).alias("meta"), visits.alias("visitas"),
                         F.array(day, F.lit(None).cast("string")).alias("dias"))


def orders_last_day(orders: DataFrame) -> DataFrame:
    """FX-13 staging: the orders of the latest day, at a new price."""
    day = F.to_date("o_orderdate")
    last = orders.agg(F.max(day).alias("_last"))
    return (orders.join(F.broadcast(last), day == F.col("_last"))
            .select("o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") + 1000).alias("o_totalprice"),
                    F.lit("web").alias("o_channel")))


def keyed_changes(lineitem: DataFrame) -> DataFrame:
    """FX-11: many changes per key, some without a key, some without a time."""
    when = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" "),
                    F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"))
    return lineitem.select(F.nullif(F.col("l_orderkey") % 100, F.lit(0)).alias("k"),
                           F.when(F.col("l_linenumber") < 7, when).alias("changed"),
                           "l_orderkey", "l_linenumber", "l_quantity")


def page_bodies(records: DataFrame, endpoint: Column, order: str, page_size: int,
                terminators: bool = True, descending: bool = True) -> DataFrame:
    """Cut records into API pages: per endpoint, by ``order``, ``page_size``
    per page, body ``{"registros": [...], "total": "<n>"}``.

    Page numbers come from ``ordinal.row_ordinal`` (no one-task window per
    endpoint); a page's list is bounded by ``page_size``.  With
    ``terminators`` each endpoint also gets trailing pages whose ``registros``
    is empty, NULL or missing.
    """
    from tablesync.operators.ordinal import row_ordinal

    rec_cols = records.columns
    numbered = row_ordinal(records.withColumn("endpoint", endpoint), ["endpoint"], order,
                           "_rn", descending=descending, total_col="_total")
    paged = numbered.withColumn("page", (F.expr(f"(_rn - 1) div {int(page_size)}") + 1).cast("int"))
    per_page = (paged.groupBy("endpoint", "page")
                .agg(F.first("_total").alias("_total"),
                     F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in rec_cols])), asc=not descending)
                     .alias("registros")))
    bodies = per_page.select(
        "endpoint", "page",
        F.to_json(F.struct("registros", F.col("_total").cast("string").alias("total"))).alias("body"))
    if not terminators:
        return bodies
    # Trailing pages come from the (small) per-page table, not the records.
    last = per_page.groupBy("endpoint").agg(F.max("page").alias("_last"), F.first("_total").alias("_total"))
    total_text = F.col("_total").cast("string")
    tail = last.select(
        "endpoint", F.explode(F.array(
            F.struct((F.col("_last") + 1).alias("page"),
                     F.concat(F.lit('{"registros":[],"total":"'), total_text, F.lit('"}')).alias("body")),
            F.struct((F.col("_last") + 2).alias("page"),
                     F.concat(F.lit('{"registros":null,"total":"'), total_text, F.lit('"}')).alias("body")),
            F.struct((F.col("_last") + 3).alias("page"),
                     F.concat(F.lit('{"total":"'), total_text, F.lit('"}')).alias("body")),
        )).alias("_t")).select("endpoint", "_t.page", "_t.body")
    return bodies.unionByName(tail)
