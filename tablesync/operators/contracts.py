"""Row contracts: validate every row, split valid rows from dead letters.

A contract is a list of ``Field`` declarations.  Each field yields a coerced
value and either NULL or an error struct; the errors of a row are
``filter(array(e1, ..., en), e -> e IS NOT NULL)``.  A row is valid when that
array is empty.  Everything is a native column expression -- one ``select``,
no UDF, no shuffle -- so a batch never fails because of a bad row.

Coercion rules (lax, in the manner of common Python model libraries):

* integer fields accept integer types, booleans, whole floats and text that is
  an optionally signed run of digits (surrounding whitespace allowed); a float
  with a fraction is ``int_from_float``, other text ``int_parsing``;
* float fields accept numbers and numeric text (``inf``/``nan`` included);
* string fields accept text only (numbers are ``string_type``);
* boolean fields accept booleans, 0/1 and the usual yes/no words;
* date / timestamp fields accept their types and ISO text;
* NULL is allowed only for ``nullable`` fields; an absent column takes the
  ``default`` when one is declared, else every row gets ``missing``.
Valid rows are projected to the contract's fields, in declaration order.

Fields nest to any depth: a ``struct`` has ``fields`` of its own, a ``list``
and a ``map`` have an ``item`` rule for their elements or values.  They are
coerced by higher-order functions, struct extras dropped and defaults filled
at every level; an error's ``loc`` is the path to it (field, position in a
list, key of a map).  A JSON object that was typed as a struct is taken as a
map where the contract wants one; its absent keys (NULL) are no entries.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.clean import NUMBER_PATTERN, py_strip, to_json_record

_NO_DEFAULT = object()

# Error codes and messages of the validation rules.
MESSAGES = {
    "missing": "Field required",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "string_type": "Input should be a valid string",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "date_type": "Input should be a valid date",
    "date_parsing": "Input should be a valid date in the format YYYY-MM-DD",
    "datetime_type": "Input should be a valid datetime",
    "datetime_parsing": "Input should be a valid datetime",
    "model_type": "Input should be a valid dictionary",
    "list_type": "Input should be a valid list",
    "dict_type": "Input should be a valid dictionary",
}

# Text accepted as booleans.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "f", "false", "n", "no", "off"]

INTEGER_TEXT = r"\A[+-]?[0-9]+\z"
DATE_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?\z"
ZONED_TEXT = (r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"
              r"([zZ]|[+-][0-9]{2}:?[0-9]{2})\z")

_SPARK_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

ERROR_TYPE = "struct<type:string,loc:array<string>,msg:string,input:string>"


def _message_map():
    return F.create_map(*[x for k, m in MESSAGES.items() for x in (F.lit(k), F.lit(m))])


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # long | int | double | string | boolean | date | timestamp | struct | list | map
    nullable: bool = False
    default: Any = _NO_DEFAULT
    fields: tuple[Field, ...] | list[Field] = ()  # of a struct
    item: Field | None = None                     # rule for the elements of a list or the values of a map

    def __post_init__(self):
        if (self.type == "struct") != bool(self.fields) or (self.type in ("list", "map")) != (self.item is not None):
            raise ValueError(f"{self.name}: a struct has fields, a list or map has an item, others have neither")

    @property
    def nested(self) -> bool:
        return self.type in ("struct", "list", "map")

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "struct":
            return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])
        if self.type == "list":
            return T.ArrayType(self.item.spark_type)
        if self.type == "map":
            return T.MapType(T.StringType(), self.item.spark_type)
        return _SPARK_TYPES[self.type]

    @property
    def has_default(self) -> bool:
        return self.default is not _NO_DEFAULT


def _coerce(c: Column, src: T.DataType, f: Field) -> tuple[Column, Column]:
    """(coerced value, error code or NULL) for a non-NULL input."""
    none = F.lit(None).cast("string")
    numeric = isinstance(src, T.NumericType)
    integral = isinstance(src, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    is_text = isinstance(src, T.StringType)
    target = f.spark_type

    if f.type in ("long", "int"):
        if integral or isinstance(src, T.BooleanType):
            v = c.try_cast(target)
            return v, F.when(v.isNull(), F.lit("int_parsing")).otherwise(none)
        if numeric:
            d = c.cast("double")
            whole = d == F.round(d, 0)
            v = F.when(whole, d.try_cast(target))
            return v, F.when(~whole, F.lit("int_from_float")).when(v.isNull(), F.lit("int_parsing")).otherwise(none)
        if is_text:
            s = py_strip(c)
            v = F.when(s.rlike(INTEGER_TEXT), s.try_cast(target))
            return v, F.when(v.isNull(), F.lit("int_parsing")).otherwise(none)
        return F.lit(None).cast(target), F.lit("int_type")

    if f.type == "double":
        if numeric:
            return c.cast("double"), none
        if is_text:
            s = py_strip(c)
            special = F.lower(s).isin("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan")
            v = F.when(s.rlike(NUMBER_PATTERN) | special, F.regexp_replace(s, "_", "").try_cast("double"))
            return v, F.when(v.isNull(), F.lit("float_parsing")).otherwise(none)
        return F.lit(None).cast(target), F.lit("float_type")

    if f.type == "string":
        if is_text:
            return c, none
        return F.lit(None).cast(target), F.lit("string_type")

    if f.type == "boolean":
        if isinstance(src, T.BooleanType):
            return c, none
        if integral:
            v = F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))
            return v, F.when(v.isNull(), F.lit("bool_parsing")).otherwise(none)
        if is_text:
            s = F.lower(py_strip(c))
            v = F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))
            return v, F.when(v.isNull(), F.lit("bool_parsing")).otherwise(none)
        return F.lit(None).cast(target), F.lit("bool_type")

    if f.type == "date":
        if isinstance(src, T.DateType):
            return c, none
        if is_text:
            s = py_strip(c)
            v = F.when(s.rlike(DATE_TEXT), s.try_cast("date"))
            return v, F.when(v.isNull(), F.lit("date_parsing")).otherwise(none)
        return F.lit(None).cast(target), F.lit("date_type")

    if f.type == "timestamp":
        if isinstance(src, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            return c.cast(target), none
        if is_text:
            s = py_strip(c)
            # A zoned value is an instant; it is kept as its UTC wall clock.
            # Spark wants seconds before a zone, and a colon within it.
            full = F.regexp_replace(F.upper(s), r"\A(.{10}[ T][0-9]{2}:[0-9]{2})([Z+-])", "$1:00$2")
            zoned = F.regexp_replace(full, r"([+-][0-9]{2})([0-9]{2})\z", "$1:$2").try_cast("timestamp")
            utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned.cast(target))
            v = F.when(s.rlike(TIMESTAMP_TEXT), s.try_cast(target)).when(s.rlike(ZONED_TEXT), utc)
            return v, F.when(v.isNull(), F.lit("datetime_parsing")).otherwise(none)
        return F.lit(None).cast(target), F.lit("datetime_type")

    raise ValueError(f"unknown contract type {f.type!r}")


_NULL_CODE = {"long": "int_type", "int": "int_type", "double": "float_type", "string": "string_type",
              "boolean": "bool_type", "date": "date_type", "timestamp": "datetime_type",
              "struct": "model_type", "list": "list_type", "map": "dict_type"}


# ------------------------------------------------------------- nested fields
def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _error(code: Column, loc: Column, given: Column) -> Column:
    return F.array(F.struct(code.alias("type"), loc.alias("loc"),
                            F.element_at(_message_map(), code).alias("msg"), given.alias("input")))


def _no_error() -> Column:
    return F.array().cast(f"array<{ERROR_TYPE}>")


def _as_text(c: Column, src: T.DataType) -> Column:
    nested = isinstance(src, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(c, {"ignoreNullFields": "false"}) if nested else c.cast("string")


def _default(f: Field) -> Column:
    if f.nested and f.default is not None:
        return F.from_json(F.lit(json.dumps(f.default)), f.spark_type)
    return F.lit(f.default).cast(f.spark_type)


def _result(value: Column, errors: Column, f: Field) -> Column:
    return F.struct(value.cast(f.spark_type).alias("v"), errors.alias("e"))


def check(c: Column | None, src: T.DataType | None, f: Field, loc: Column) -> Column:
    """``struct<v, e>``: the coerced value of ``c`` (None: the field is absent)
    and its errors, with their paths below ``loc``."""
    nothing = F.lit(None).cast(f.spark_type)
    if c is None:
        if f.has_default:
            return _result(_default(f), _no_error(), f)
        return _result(nothing, _error(F.lit("missing"), loc, F.lit(None).cast("string")), f)
    code = F.lit(_NULL_CODE[f.type])
    wrong = _result(nothing, _error(code, loc, _as_text(c, src)), f)
    if not f.nested:
        v, code_or_null = _coerce(c, src, f)
        good = _let(F.struct(v.alias("v"), code_or_null.alias("c")), lambda r: _result(
            r["v"], F.when(r["c"].isNotNull(), _error(r["c"], loc, _as_text(c, src))).otherwise(_no_error()), f))
    elif f.type == "struct" and isinstance(src, T.StructType):
        types = {x.name: x.dataType for x in src.fields}
        parts = F.struct(*[
            check(c.getField(x.name) if x.name in types else None, types.get(x.name), x,
                  F.concat(loc, F.array(F.lit(x.name)))).alias(f"_{i}") for i, x in enumerate(f.fields)])
        good = _let(parts, lambda r: _result(
            F.struct(*[r[f"_{i}"]["v"].alias(x.name) for i, x in enumerate(f.fields)]),
            F.concat(*[r[f"_{i}"]["e"] for i in range(len(f.fields))]), f))
    elif f.type == "list" and isinstance(src, T.ArrayType):
        parts = F.transform(c, lambda x, i: check(
            x, src.elementType, f.item, F.concat(loc, F.array(i.cast("string")))))
        good = _let(parts, lambda r: _result(F.transform(r, lambda x: x["v"]),
                                             F.flatten(F.transform(r, lambda x: x["e"])), f))
    elif f.type == "map" and isinstance(src, (T.MapType, T.StructType)):
        def entry(key: Column, value: Column, dt: T.DataType) -> Column:
            return F.struct(key.alias("k"), check(value, dt, f.item, F.concat(loc, F.array(key))).alias("r"))

        if isinstance(src, T.MapType):
            parts = F.transform(F.map_entries(c), lambda x: entry(x["key"].cast("string"), x["value"], src.valueType))
        else:
            parts = F.filter(F.array(*[F.when(c.getField(x.name).isNotNull(), entry(
                F.lit(x.name), c.getField(x.name), x.dataType)) for x in src.fields]), lambda x: x.isNotNull())
        good = _let(parts, lambda r: _result(
            F.map_from_entries(F.transform(r, lambda x: F.struct(x["k"], x["r"]["v"]))),
            F.flatten(F.transform(r, lambda x: x["r"]["e"])), f))
    else:
        good = wrong
    at_null = _result(nothing, _no_error(), f) if f.nullable else wrong
    return F.when(c.isNull(), at_null).otherwise(good)


def field_checks(df: DataFrame, contract: list[Field]) -> tuple[list[Column], list[Column]]:
    """Per field of a flat contract: the coerced value and the error code (NULL when fine)."""
    types = {fl.name: fl.dataType for fl in df.schema.fields}
    values, codes = [], []
    for f in contract:
        if f.name not in types:
            if f.has_default:
                values.append(F.lit(f.default).cast(f.spark_type))
                codes.append(F.lit(None).cast("string"))
            else:
                values.append(F.lit(None).cast(f.spark_type))
                codes.append(F.lit("missing"))
            continue
        c = F.col(f"`{f.name}`")
        v, code = _coerce(c, types[f.name], f)
        null_code = F.lit(None).cast("string") if f.nullable else F.lit(_NULL_CODE[f.type])
        codes.append(F.when(c.isNull(), null_code).otherwise(code))
        values.append(F.when(c.isNull(), F.lit(None).cast(f.spark_type)).otherwise(v))
    return values, codes


def annotate(df: DataFrame, contract: list[Field], record_columns: list[str] | None = None) -> DataFrame:
    """Input columns + coerced ``_v_<field>`` + ``_record`` (row JSON of
    ``record_columns``, default all) + ``_errors`` (array of error structs) +
    ``_valid``.

    Two projections: the first computes each field's value and error code
    once; the second builds the error structs from those columns, so no
    parsing expression is evaluated twice per row.
    """
    flat = [f for f in contract if not f.nested]
    values, codes = field_checks(df, flat)
    types = {fl.name: fl.dataType for fl in df.schema.fields}
    cols = [F.col(f"`{c}`") for c in df.columns]
    checked = df.select(
        *cols,
        *[v.alias(f"_v_{f.name}") for v, f in zip(values, flat)],
        *[code.alias(f"_c_{f.name}") for f, code in zip(flat, codes)],
        *[check(F.col(f"`{f.name}`") if f.name in types else None, types.get(f.name), f, F.array(F.lit(f.name)))
          .alias(f"_n_{f.name}") for f in contract if f.nested],
        to_json_record(df.select(*record_columns) if record_columns else df, "_record"),
    )
    messages = _message_map()
    errors, run = [], []  # arrays of errors: runs of flat fields, and nested ones between them
    for f in contract:
        if f.nested:
            errors, run = [*errors, F.array(*run), F.col(f"`_n_{f.name}`")["e"]] if run else [
                *errors, F.col(f"`_n_{f.name}`")["e"]], []
            continue
        code = F.col(f"`_c_{f.name}`")
        given = F.col(f"`{f.name}`").cast("string") if f.name in df.columns else F.lit(None).cast("string")
        run.append(F.when(code.isNotNull(), F.struct(
            code.alias("type"), F.array(F.lit(f.name)).alias("loc"),
            F.element_at(messages, code).alias("msg"), given.alias("input"))))
    errors += [F.array(*run)] if run else []
    errs = F.filter(F.concat(*errors) if len(errors) > 1 else errors[0], lambda e: e.isNotNull())
    # Validity comes straight from the codes, so the valid path never builds
    # the error array (a higher-order function, evaluated outside codegen).
    valid = F.coalesce(*[F.col(f"`_c_{f.name}`") for f in flat], F.lit(None).cast("string")).isNull()
    for f in contract:
        if f.nested:
            valid = valid & (F.size(F.col(f"`_n_{f.name}`")["e"]) == 0)
    return checked.select(
        *cols, *[(F.col(f"`_n_{f.name}`")["v"].alias(f"_v_{f.name}") if f.nested else F.col(f"`_v_{f.name}`"))
                 for f in contract], "_record", errs.alias("_errors"), valid.alias("_valid"))


def valid_rows(annotated: DataFrame, contract: list[Field]) -> DataFrame:
    """Valid rows, coerced and narrowed to the contract's fields."""
    return annotated.where("_valid").select(*[F.col(f"`_v_{f.name}`").alias(f.name) for f in contract])


def invalid_rows(annotated: DataFrame) -> DataFrame:
    """Rejected rows with their original columns and the error array."""
    return annotated.where(~F.col("_valid")).drop("_valid", "_record", *[
        c for c in annotated.columns if c.startswith("_v_")])


def errors_json(c: Column | str = "_errors") -> Column:
    """Error array as JSON text; NULL inputs stay as ``null`` fields."""
    return F.to_json(F.col(c) if isinstance(c, str) else c, {"ignoreNullFields": "false"})


def dead_letters(annotated: DataFrame, run_id: Column | int, stream: str,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """Dead-letter table rows: (run_id, stream, record JSON, errors JSON, *extra)."""
    rid = run_id if isinstance(run_id, Column) else F.lit(run_id).cast("long")
    return annotated.where(~F.col("_valid")).select(
        rid.alias("run_id"), F.lit(stream).alias("stream"),
        F.col("_record").alias("record"), errors_json().alias("errors"), *extra)


def validate(df: DataFrame, contract: list[Field] | None) -> tuple[DataFrame, DataFrame | None]:
    """(valid, annotated) -- without a contract every row is valid as is."""
    if not contract:
        return df, None
    ann = annotate(df, contract)
    return valid_rows(ann, contract), ann
