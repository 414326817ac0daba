"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views.  The
fixture CTEs restate FIXTURES.md in DuckDB's dialect; regexes are written in
the syntax both Java regex and RE2 accept.
"""

from __future__ import annotations

# Stated here on their own, not taken from the code they check.
DATE_PREFIX_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
DSN_PASSWORD_PATTERN = r"(://[^:/@\s]+:)[^@/\s]+(@)"
NUMBER_PATTERN = (r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)"
                  r"([eE][+-]?[0-9](_?[0-9])*)?$")
WS_CODE_POINTS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
INTEGER_TEXT = r"^[+-]?[0-9]+$"
MESSAGES = {
    "string_type": "Input should be a valid string",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
}
NEXT_STAGE = {"EXTRACT": "VALIDATE", "VALIDATE": "LOAD", "LOAD": "VERIFY", "VERIFY": "EXTRACT"}
CURRENT_CURSOR = "2024-01-29 12:00:00"
SINCE = "2024-01-15 00:00:00"
FAILED_DAY = "1996-03-15"
PAGE_SIZE = 500


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_SQL = " || ".join(f"chr({cp})" for cp in WS_CODE_POINTS)


def d_strip(c: str) -> str:
    return f"trim({c}, {WS_SQL})"


def d_blank(c: str) -> str:
    return f"case when {d_strip(c)} = '' then null else {c} end"


def d_sanitize(c: str) -> str:
    s = d_strip(c)
    h = f"substr({s}, 1, 10)"
    bad = (f"({s} = '' or (regexp_matches({s}, {_lit(DATE_PREFIX_PATTERN)}) and "
           f"(starts_with({h}, '0000') or substr({h}, 6, 2) = '00' or substr({h}, 9, 2) = '00' "
           f"or try_cast({h} as date) is null)))")
    return f"case when {bad} then null else {c} end"


FX1 = """fx1 as (
  select event_id as id,
    case event_id % 7 when 0 then '' when 1 then '   '
      when 2 then concat(' ', event_type, ' ') else event_type end as nome,
    case event_id % 5 when 0 then '0000-00-00'
      when 1 then concat('2024-', lpad(cast(event_id % 14 as varchar), 2, '0'), '-',
                         lpad(cast(event_id % 33 as varchar), 2, '0'))
      when 2 then concat('2023-02-', lpad(cast(event_id % 31 as varchar), 2, '0'), ' 10:30:00')
      when 3 then concat('ref ', cast(event_id as varchar)) else '' end as data_ref,
    case event_id % 11 when 0 then 'xx' when 1 then null else cast(event_id % 50 as varchar) end as qtd,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as ultima_atualizacao,
    event_type as stream
  from events)"""

FX1_CLEAN = f"""fx1c as (
  select id, {d_sanitize('nome')} as nome, {d_sanitize('data_ref')} as data_ref,
    {d_sanitize('qtd')} as qtd, {d_sanitize('ultima_atualizacao')} as ultima_atualizacao,
    {d_sanitize('stream')} as stream
  from fx1)"""


def _err(code: str, field: str, value: str) -> str:
    return (f"struct_pack(type := {_lit(code)}, loc := [{_lit(field)}], msg := {_lit(MESSAGES[code])}, "
            f"input := cast({value} as varchar))")


_QTD_S = d_strip("qtd")
FX1_CHECK = f"""fx1v as (
  select *,
    list_filter([
      case when nome is null then {_err('string_type', 'nome', 'nome')} end,
      case when qtd is null then {_err('int_type', 'qtd', 'qtd')}
           when not regexp_matches({_QTD_S}, {_lit(INTEGER_TEXT)}) or try_cast({_QTD_S} as integer) is null
           then {_err('int_parsing', 'qtd', 'qtd')} end
    ], lambda x: x is not null) as errs,
    try_cast({_QTD_S} as integer) as qtd_v
  from fx1c)"""

# FX-9: the source some time later.
LATER = """later as (
  select id, case when id % 8 = 0 then '' else nome end as nome, data_ref,
    case when id % 4 = 0 then '77' else qtd end as qtd,
    case when id % 4 = 0 then strftime(strptime(ultima_atualizacao, '%Y-%m-%d %H:%M:%S') + interval 400 day,
                                       '%Y-%m-%d %H:%M:%S') else ultima_atualizacao end as ultima_atualizacao,
    stream
  from fx1
  union all
  select id + 1000000000, nome, data_ref, qtd,
    strftime(strptime(ultima_atualizacao, '%Y-%m-%d %H:%M:%S') + interval 400 day, '%Y-%m-%d %H:%M:%S'), stream
  from fx1 where id % 10 = 3)"""

def _nested_err(kind: str, loc: str, given: str) -> str:
    """One error at a path (a list expression), as the contract words it."""
    messages = {"int_type": "Input should be a valid integer", "string_type": "Input should be a valid string",
                "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
                "model_type": "Input should be a valid dictionary"}
    return (f"struct_pack(type := '{kind}', loc := {loc}, msg := '{messages[kind]}', "
            f"input := cast({given} as varchar))")


def _int_err(value: str, loc: str) -> str:
    return f"case when try_cast({value} as integer) is null then {_nested_err('int_parsing', loc, value)} end"


FX14 = f"""raw14 as (
  select event_id as id,
    case when event_id % 9 = 0 then 'x' || event_id else cast(event_id % 100 as varchar) end as codigo,
    case when event_id % 8 <> 0 then event_type end as nome,
    json_extract_string(props, '$.k') as k,
    case when event_id % 23 = 0 then 'abc' else cast(user_id as varchar) end as u,
    list_transform(range(event_id % 4), lambda i: struct_pack(sku := 's' || i, qtd := case
      when (event_id + i) % 11 = 0 then 'muitos'
      when (event_id + i) % 13 <> 0 then cast((event_id + i) % 50 as varchar) end)) as itens
  from events),
checked14 as (
  select *, try_cast(codigo as integer) as codigo_v,
    case when id % 19 <> 0 then struct_pack(codigo := codigo, nome := nome, extra := cast(id as varchar)) end as cliente,
    list_filter(list_concat(
      case when id % 19 = 0 then [{_nested_err('model_type', "['cliente']", 'null')}]
           else [{_int_err('codigo', "['cliente', 'codigo']")},
                 case when nome is null then {_nested_err('string_type', "['cliente', 'nome']", 'null')} end] end,
      list_transform(range(len(itens)), lambda i: case when itens[i + 1].qtd is not null then
        {_int_err('itens[i + 1].qtd', "['itens', cast(i as varchar), 'qtd']")} end),
      [case when k is null then {_nested_err('int_type', "['tags', 'k']", 'null')} else {_int_err('k', "['tags', 'k']")} end,
       {_int_err('u', "['tags', 'u']")}]
    ), lambda x: x is not null) as errs
  from raw14)"""

FX2 = """base as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
  where o_orderdate < timestamp '2000-01-01 00:00:00'),
delta as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 as o_totalprice,
    case when o_orderkey % 2 = 0 then 'web' else 'loja' end as o_channel
  from orders where o_orderdate >= timestamp '1999-07-01 00:00:00')"""

FX2_UPSERT = FX2 + """,
upserted as (
  select b.*, cast(null as varchar) as o_channel from base b
  where not exists (select 1 from delta d where d.o_orderkey = b.o_orderkey)
  union all select * from delta)"""

FX4 = """fx4 as (
  select o_orderkey as run_id, concat('c', cast(o_custkey % 5 as varchar)) as client,
    case o_orderkey % 3 when 0 then 'clientes' when 1 then 'contratos' else 'titulos' end as pipeline,
    case o_orderstatus when 'F' then 'FAILED' when 'O' then 'SUCCESS' else 'RUNNING' end as status,
    o_orderdate as started_at, cast(floor(o_totalprice) as bigint) as records_out,
    case o_orderstatus when 'F' then ['EXTRACT', 'VALIDATE', 'LOAD', 'VERIFY'][o_orderkey % 4 + 1]
      when 'O' then 'VERIFY' else 'EXTRACT' end as stage,
    case when o_orderstatus in ('F', 'O') then cast(cast(floor(o_totalprice) as bigint) % 3600 as double)
      end as duration_s,
    case o_orderstatus when 'F' then concat('erro ', cast(o_orderkey as varchar)) end as error
  from orders)"""

FX5 = f"""ev5 as (
  select event_type as endpoint, event_id, ts, user_id, event_type, value, props,
    row_number() over (partition by event_type order by event_id desc) as rn,
    count(*) over (partition by event_type) as total
  from events),
pages5 as (
  select *, cast((rn - 1) // {PAGE_SIZE} + 1 as integer) as page from ev5),
ledger5 as (
  select endpoint, cast(page as bigint) as page, count(*) as n_records, any_value(total) as total
  from pages5 group by endpoint, page),
progress5 as (
  select endpoint, page, n_records, total,
    cast(sum(n_records) over (partition by endpoint order by page
         rows between unbounded preceding and current row) as bigint) as fetched
  from ledger5)"""

STAGE_ARRAY = "['EXTRACT', 'VALIDATE', 'LOAD', 'VERIFY']"

CHECKPOINT_LOG = f"""cplog as (
  select concat('c', cast(user_id % 5 as varchar)) as client, event_type as pipeline,
    {STAGE_ARRAY}[event_id % 4 + 1] as stage, ts as completed_at,
    concat('staging/', event_type, '/run=', cast(event_id as varchar)) as data_path,
    event_id as seq, event_id % 13 = 0 as cleared
  from events),
cplatest as (
  select client, pipeline, stage, completed_at, data_path, seq from (
    select *, row_number() over (partition by client, pipeline order by seq desc) as r from cplog)
  where r = 1 and not cleared)"""

DEAD = f"""dl as (
  select cast(floor(id / 10) as bigint) as run_id, 'events' as stream,
    cast(to_json(struct_pack(id := id, nome := nome, data_ref := data_ref, qtd := qtd,
                        ultima_atualizacao := ultima_atualizacao)) as varchar) as record,
    cast(to_json(errs) as varchar) as errors, id
  from fx1v where len(errs) > 0)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _next_stage_case(col: str) -> str:
    whens = " ".join(f"when {_lit(k)} then {_lit(v)}" for k, v in NEXT_STAGE.items())
    return f"coalesce(case {col} {whens} end, 'EXTRACT')"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ---------------------------------------------------------------- upserts
    q["delta_upsert"] = _with(FX2_UPSERT) + "select * from upserted"
    q["delta_first_run"] = ("select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 as o_totalprice "
                            "from orders")
    q["publish_delta"] = q["delta_upsert"]
    q["publish_buckets"] = """with d as (select max(cast(o_orderdate as date)) as last from orders)
select o_orderkey, o_custkey, o_orderstatus,
  o_totalprice + 1000 + case when cast(o_orderdate as date) = last then 3 else 0 end as o_totalprice,
  case when cast(o_orderdate as date) = last then 'web' end as o_channel
from orders, d"""
    q["dedupe_latest"] = """with c as (
  select nullif(l_orderkey % 100, 0) as k,
    case when l_linenumber < 7 then concat(strftime(l_shipdate, '%Y-%m-%d'), ' ',
      lpad(cast(l_orderkey as varchar), 12, '0'), cast(l_linenumber as varchar)) end as changed,
    l_orderkey, l_linenumber, l_quantity from lineitem)
select * from c where k is null
union all
select * exclude (r) from (
  select *, row_number() over (partition by k order by changed desc nulls last) as r from c where k is not null)
where r = 1"""
    q["delta_idempotent"] = q["delta_upsert"]
    q["full_refresh"] = _with(FX2) + "select * from delta"
    q["delta_dup_pk"] = """with
base as (select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate < timestamp '2000-01-01 00:00:00'),
delta as (select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '2000-01-01 00:00:00')
select * from base b where not exists (select 1 from delta d where d.l_orderkey = b.l_orderkey)
union all select * from delta"""
    q["delta_null_pk"] = """with
shaped as (select nullif(l_orderkey % 10, 0) as k, l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem),
base as (select k, l_orderkey, l_linenumber, l_quantity from shaped where l_shipdate < timestamp '2001-10-25 00:00:00'),
delta as (select k, l_orderkey, l_linenumber, l_quantity from shaped where l_shipdate >= timestamp '2001-10-25 00:00:00')
select * from base b where not exists (select 1 from delta d where d.k = b.k)
union all select * from delta"""
    q["schema_evolve"] = """with
base as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
         where o_orderdate < timestamp '2000-01-01 00:00:00'),
delta as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 as o_totalprice,
    case when o_orderkey % 2 = 0 then 'web' else 'loja' end as o_channel,
    cast(cast(substr(o_orderpriority, 1, 1) as integer) as bigint) as o_priority_rank,
    cast(cast((o_custkey % 1000) / 8 as decimal(18,3)) as double) as o_discount,
    o_orderstatus = 'O' as o_is_open,
    cast(o_orderdate as date) as o_day,
    cast(to_json(struct_pack(cust := o_custkey, prio := o_orderpriority)) as varchar) as o_meta
  from orders where o_orderdate >= timestamp '1999-07-01 00:00:00')
select b.*, cast(null as varchar) as o_channel, cast(null as bigint) as o_priority_rank,
  cast(null as double) as o_discount, cast(null as boolean) as o_is_open,
  cast(null as date) as o_day, cast(null as varchar) as o_meta
from base b where not exists (select 1 from delta d where d.o_orderkey = b.o_orderkey)
union all select * from delta"""
    q["schema_missing"] = _with(FX2) + """,
basew as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
          where o_orderdate < timestamp '2000-01-01 00:00:00')
select b.*, cast(null as varchar) as o_channel from basew b
where not exists (select 1 from delta d where d.o_orderkey = b.o_orderkey)
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(null as varchar) as o_orderpriority, o_channel
from delta"""
    q["loaded_count"] = _with(FX2_UPSERT) + """
select (select count(*) from upserted) as target_rows, (select count(*) from delta) as loaded"""
    q["verify_counts"] = _with(FX1, FX1_CLEAN, FX1_CHECK) + """,
ex as (select stream, count(*) as extracted from fx1 group by stream),
va as (select stream, count(*) as expected from fx1v where len(errs) = 0 group by stream),
lo as (select stream, count(*) as loaded from fx1v
       where len(errs) = 0 and stream <> 'view' and not (stream = 'click' and id % 50 = 7) group by stream)
select ex.stream, extracted, cast(coalesce(expected, 0) as bigint) as expected,
  coalesce(loaded, 0) as loaded,
  case when coalesce(loaded, 0) = 0 or loaded <> coalesce(expected, 0) then 'failed' else 'success' end as status
from ex left join va using (stream) left join lo using (stream)"""

    # --------------------------------------------------------------- cleaning
    q["select_fields"] = "select o_orderkey, o_orderstatus, o_totalprice from orders"
    q["transform_sql"] = ("select o_orderkey, upper(o_orderpriority) as prio, o_totalprice from orders "
                          "where o_orderstatus = 'F'")
    q["sanitize_blank"] = _with(FX1) + f"""
select id, {d_blank('nome')} as nome, {d_blank('data_ref')} as data_ref, {d_blank('qtd')} as qtd,
  {d_blank('ultima_atualizacao')} as ultima_atualizacao from fx1"""
    q["sanitize_date"] = _with(FX1, FX1_CLEAN) + \
        "select id, nome, data_ref, qtd, ultima_atualizacao from fx1c"
    q["narrow_types"] = _with(FX1, FX1_CLEAN) + """
select id, nome, data_ref, qtd, cast(ultima_atualizacao as timestamp) as ultima_atualizacao,
  cast(substr(ultima_atualizacao, 1, 10) as date) as dia from fx1c"""
    q["narrow_nested"] = """select event_id as id,
  case when event_id % 5 <> 0 then cast(ts as date) end as criado,
  case when event_id % 5 <> 0 then case when event_id % 7 = 0 then 'n/d' else strftime(ts, '%Y-%m-%d') end end as nota,
  case when event_id % 3 <> 0 then cast(2 as integer) end as n,
  case when event_id % 3 <> 0 then date_trunc('second', ts) end as em,
  case when event_id % 3 <> 0 then user_id end as quem, cast(ts as date) as dia
from events"""
    q["redact"] = (f"select c_custkey, regexp_replace(concat('erro postgresql://u:', c_name, '@h:5432/db'), "
                   f"{_lit(DSN_PASSWORD_PATTERN)}, '\\1***\\2', 'g') as message from customer")
    q["strip_nul"] = ("select c_custkey, replace(concat(c_name, chr(0), c_mktsegment), chr(0), '') as label "
                      "from customer")
    q["to_json_record"] = _with(FX1, FX1_CLEAN) + """
select id, cast(to_json(struct_pack(id := id, nome := nome, data_ref := data_ref, qtd := qtd,
                               ultima_atualizacao := ultima_atualizacao)) as varchar) as record from fx1c"""
    q["json_cursor"] = "select event_id, json_extract_string(props, '$.k') as cursor_value from events"
    ts = d_strip("total_raw")
    q["parse_total"] = f"""with t as (
  select event_id,
    case event_id % 12 when 0 then cast(event_id as varchar)
      when 1 then concat(cast(event_id as varchar), '.0') when 2 then ''
      when 3 then concat('-', cast(event_id as varchar)) when 4 then 'abc' when 5 then '-0.5'
      when 6 then concat(' ', cast(user_id as varchar), ' ') when 7 then 'NaN' when 8 then 'inf'
      when 9 then concat(cast(user_id as varchar), 'd')
      when 10 then concat(cast(event_id % 10 as varchar), 'e3')
      else concat(cast(event_id % 100 as varchar), '.9') end as total_raw
  from events),
n as (select event_id, total_raw,
  case when regexp_matches({ts}, {_lit(NUMBER_PATTERN)})
       then try_cast(trunc(try_cast(replace({ts}, '_', '') as double)) as bigint) end as total from t)
select event_id, total_raw, case when total >= 0 then total end as total from n"""

    # ----------------------------------------------------------------- cursor
    q["delta_filter"] = _with(FX1) + f"""
select id, nome, data_ref, qtd, ultima_atualizacao from fx1 where ultima_atualizacao >= {_lit(SINCE)}"""
    q["default_lookback"] = """
select event_id, strftime(cast(timezone('America/Sao_Paulo', ts at time zone 'UTC') as date) - 1,
                          '%Y-%m-%d 00:00:00') as lookback from events"""
    q["cursor_max"] = _with(FX1) + f"""
select stream, greatest({_lit(CURRENT_CURSOR)}, max(nullif(ultima_atualizacao, ''))) as cursor_ts,
  max(nullif(data_ref, '')) as cursor_ref,
  arg_max(nullif(qtd, ''), try_cast(nullif(qtd, '') as double)) as cursor_qtd
from fx1 group by stream"""
    q["cursor_lookup"] = """with log as (
  select concat('c', cast(user_id % 5 as varchar)) as client, event_type as pipeline, event_id as seq,
    to_json(struct_pack(replication_key_value := strftime(ts, '%Y-%m-%d %H:%M:%S'))) as metadata
  from events)
select client, pipeline, arg_max(json_extract_string(metadata, '$.replication_key_value'), seq) as cursor
from log group by client, pipeline"""

    # -------------------------------------------------------------- contracts
    q["validate_valid"] = _with(FX1, FX1_CLEAN, FX1_CHECK) + \
        "select id, nome, data_ref, qtd, ultima_atualizacao from fx1v where len(errs) = 0"
    q["validate_coerce"] = _with(FX1, FX1_CLEAN, FX1_CHECK) + \
        "select id, nome, qtd_v as qtd, data_ref, 'A' as status from fx1v where len(errs) = 0"
    q["validate_dead"] = _with(FX1, FX1_CLEAN, FX1_CHECK) + (
        "select id, nome, data_ref, qtd, ultima_atualizacao, cast(to_json(errs) as varchar) as errors "
        "from fx1v where len(errs) > 0")
    q["dead_letters"] = _with(FX1, FX1_CLEAN, FX1_CHECK, DEAD) + "select run_id, stream, record, errors from dl"
    q["validate_nested"] = _with(FX14) + """
select id, codigo_v as codigo, cast(len(itens) as integer) as n_itens,
  cast(to_json(struct_pack(codigo := codigo_v, nome := nome, pais := 'BR')) as varchar) as cliente,
  cast(to_json(list_transform(itens, lambda x: struct_pack(sku := x.sku, qtd := try_cast(x.qtd as integer)))) as varchar)
    as itens,
  '{"k":' || try_cast(k as integer) || ',"u":' || try_cast(u as integer) || '}' as tags
from checked14 where len(errs) = 0"""
    q["dead_letters_nested"] = _with(FX14) + """
select cast(floor(id / 10) as bigint) as run_id, 'events' as stream,
  cast(to_json(struct_pack(id := id, cliente := cliente, itens := itens, tags := struct_pack(k := k, u := u))) as varchar)
    as record,
  cast(to_json(errs) as varchar) as errors
from checked14 where len(errs) > 0"""
    q["dead_letters_latest"] = _with(FX1, FX1_CLEAN, FX1_CHECK, DEAD) + """,
runs as (select cast(floor(event_id / 10) as bigint) as run_id from events group by 1),
latest as (select concat('c', cast(run_id % 5 as varchar)) as client, max(run_id) as run_id
           from runs group by 1)
select dl.run_id, dl.stream, dl.record, dl.errors, dl.id, e.ts as created_at, latest.client
from dl join latest on dl.run_id = latest.run_id join events e on e.event_id = dl.id"""

    # ----------------------------------------------------------------- ledger
    q["status_top20"] = _with(FX4) + "select * from fx4 order by started_at desc, run_id desc limit 20"
    q["status_top20_client"] = _with(FX4) + \
        "select * from fx4 where client = 'c1' order by started_at desc, run_id desc limit 20"
    q["failed_on_day"] = _with(FX4) + f"""
select client, pipeline, run_id, started_at, error from fx4
where status = 'FAILED' and cast(started_at as date) = date {_lit(FAILED_DAY)}"""
    q["volume_by_day"] = _with(FX4) + """
select pipeline, cast(started_at as date) as day, max(records_out) as rows
from fx4 where status = 'SUCCESS' group by pipeline, cast(started_at as date)"""
    q["run_summary"] = _with(FX4) + """,
ps as (
  select client, started_at, pipeline as stream, max(case when status = 'FAILED' then 1 else 0 end) as f,
    cast(sum(records_out) as bigint) as records_loaded, count(*) as runs, max(error) as error
  from fx4 group by client, started_at, pipeline)
select client, started_at, case when max(f) = 1 then 'failed' else 'success' end as status,
  cast(sum(records_loaded) as bigint) as records_loaded,
  cast(to_json(list(json_merge_patch(to_json(struct_pack(
      stream := stream, status := case when f = 1 then 'failed' else 'success' end,
      records_loaded := records_loaded, runs := runs)),
    case when error is null then '{}' else to_json(struct_pack(error := error)) end) order by stream)) as varchar) as streams
from ps group by client, started_at"""
    q["run_fold"] = _with(FX4) + """
select run_id, client, started_at,
  case when status = 'RUNNING' then null
       else started_at + to_seconds(records_out % 3600) end as finished_at,
  status, case when status = 'RUNNING' then null else records_out end as records_out,
  case when status = 'RUNNING' then null else cast(records_out % 3600 as double) end as duration_s
from fx4"""
    q["ledger_snapshot"] = q["run_fold"]
    q["event_counts"] = f"""with se as (
  select ['stage_start', 'stage_done', 'stage_skipped'][event_id % 3 + 1] as event_type,
    {STAGE_ARRAY}[event_id % 4 + 1] as stage,
    case when event_id % 3 = 1 then cast(json_extract_string(props, '$.k') as integer) end as records
  from events)
select event_type, stage, count(*) as n, cast(sum(records) as bigint) as records
from se group by event_type, stage"""
    q["checkpoint_latest"] = _with(CHECKPOINT_LOG) + "select * from cplatest"
    q["ledger_snapshot_checkpoints"] = q["checkpoint_latest"]
    q["resume_point"] = _with(CHECKPOINT_LOG) + \
        f"select client, pipeline, stage, {_next_stage_case('stage')} as resume_stage from cplatest"

    # ------------------------------------------------------------------ pages
    q["page_explode"] = _with(FX5) + \
        "select endpoint, page, total, event_id, ts, user_id, event_type, value, props from pages5"
    q["paged_scan"] = "select event_id, ts, user_id, event_type, value, props from events"
    q["paged_delta_scan"] = (f"select event_id, ts, user_id, event_type, value, props from events "
                             f"where ts >= timestamp {_lit(SINCE)}")
    q["page_progress"] = _with(FX5) + f"""
select endpoint, page, n_records, total, fetched,
  case when total > 0 then round(fetched / total * 100, 1) end as pct,
  case when total > 0 then cast(ceil(total / {PAGE_SIZE}) as bigint) end as total_pages
from progress5"""
    q["page_eta"] = f"""with p as (
  select event_type as endpoint, ts, count(*) over (partition by event_type) as total,
    (row_number() over (partition by event_type order by event_id) - 1) // {PAGE_SIZE} + 1 as page
  from events),
l as (
  select endpoint, cast(page as bigint) as page, count(*) as n, any_value(total) as total, max(ts) as seen
  from p group by endpoint, page),
r as (
  select endpoint, page, total,
    cast(sum(n) over (partition by endpoint order by page) as bigint) as fetched,
    (epoch_us(max(seen) over (partition by endpoint order by page)) - epoch_us(min(seen) over (partition by endpoint)))
      / 1000000.0::double as elapsed_s
  from l)
select endpoint, page, fetched, total, elapsed_s,
  case when total > 0 and fetched > 0 and fetched < total
       then elapsed_s / cast(fetched as double) * (cast(total as double) - cast(fetched as double))
  end as eta_s
from r"""
    q["paged_pushdown"] = q["paged_delta_scan"] + " and event_type in ('view', 'click')"

    # ------------------------------------------------------------------ files
    q["ndjson_scan"] = "select * from orders"
    q["paged_short_pages"] = q["paged_scan"]
    q["staging_scan"] = q["sanitize_date"]
    q["staging_replace"] = _with(FX1, LATER) + "select id, nome, data_ref, qtd, ultima_atualizacao from later"
    q["paged_sync"] = """
select event_id, case when event_id % 4 = 0 then ts + interval 400 day else ts end as ts, user_id, event_type,
  case when event_id % 4 = 0 then value + 1 else value end as value, props from events
union all
select event_id + 1000000000, ts + interval 400 day, user_id, event_type, value, props
from events where event_id % 10 = 3"""
    q["paged_stream"] = q["paged_sync"]
    q["cursor_numeric"] = """with m as (select max(event_id) as top from events)
select event_id, user_id, case when event_id = top then value + 1 else value end as value from events, m
union all
select event_id + 1000000000, user_id, value from events where event_id % 10 = 3"""
    q["cursor_raw"] = """
select 'c0' as client, 'eventos' as pipeline, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) as cursor from events"""

    # -------------------------------------------------------------- streaming
    q["stream_upsert"] = q["delta_upsert"]

    # -------------------------------------------------------------------- job
    # The first run's valid rows, over them the valid rows at or after its cursor.
    cleaned = _with(FX1, FX1_CLEAN, FX1_CHECK)
    later = FX1_CLEAN.replace("fx1c as", "laterc as").replace("from fx1)", "from later)")
    later_check = FX1_CHECK.replace("fx1v as", "laterv as").replace("from fx1c)", "from laterc)")
    q["sync_job"] = cleaned.rstrip() + f""",
{LATER},
{later},
{later_check},
delta as (
  select * from laterv where len(errs) = 0
    and ultima_atualizacao >= (select max(ultima_atualizacao) from fx1))
select id, nome, qtd_v as qtd, data_ref, 'A' as status from fx1v
where len(errs) = 0 and id not in (select id from delta)
union all
select id, nome, qtd_v as qtd, data_ref, 'A' as status from delta"""
    return q
