"""Type rules for columns added by schema evolution and for staged-text narrowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type a column gets when delta mode adds it to the target.
#   boolean -> boolean; every integer width -> bigint; float/double -> double;
#   decimal/numeric -> double; date -> date; timestamp (with zone) -> timestamp;
#   timestamp without zone -> timestamp_ntz; string -> string;
#   anything else (struct, array, map, binary, ...) -> text (JSON for nested).


def added_column_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.BooleanType):
        return T.BooleanType()
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)):
        return dt
    return T.StringType()


def to_added_type(c: Column, dt: T.DataType) -> Column:
    """Convert a staged value to the type its new target column gets."""
    target = added_column_type(dt)
    if isinstance(target, T.StringType) and not isinstance(dt, T.StringType):
        if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c)
        if isinstance(dt, T.BinaryType):
            return F.base64(c)
        return c.cast("string")
    return c.cast(target)


# The text shapes narrowed by the staging scan.
DATE_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"


ITEM, VALUE = "[]", "{}"  # steps of a path into array elements and map values
Path = tuple[str, ...]


def _leaves(dt: T.DataType, path: Path = ()) -> list[Path]:
    """Paths of the text leaves of a type."""
    if isinstance(dt, T.StringType):
        return [path]
    if isinstance(dt, T.StructType):
        return [p for f in dt.fields for p in _leaves(f.dataType, (*path, f.name))]
    if isinstance(dt, T.ArrayType):
        return _leaves(dt.elementType, (*path, ITEM))
    if isinstance(dt, T.MapType):
        return _leaves(dt.valueType, (*path, VALUE))
    return []


def _inside(c: Column, dt: T.DataType, path: Path):
    """``(column, type)`` one step down."""
    if isinstance(dt, T.StructType):
        return c.getField(path[0]), dt[path[0]].dataType
    if isinstance(dt, T.MapType):
        return F.map_values(c), dt.valueType
    return c, dt.elementType


def _every(c: Column, dt: T.DataType, path: Path, holds) -> Column:
    """Whether ``holds`` is true of all values of the leaf that are not NULL."""
    if not path:
        return c.isNull() | holds(c)
    inner, inner_type = _inside(c, dt, path)
    if isinstance(dt, T.StructType):
        return _every(inner, inner_type, path[1:], holds)
    return F.coalesce(F.forall(inner, lambda x: _every(x, inner_type, path[1:], holds)), F.lit(True))


def _some(c: Column, dt: T.DataType, path: Path) -> Column:
    """Whether the leaf has a value that is not NULL."""
    if not path:
        return c.isNotNull()
    inner, inner_type = _inside(c, dt, path)
    if isinstance(dt, T.StructType):
        return _some(inner, inner_type, path[1:])
    return F.coalesce(F.exists(inner, lambda x: _some(x, inner_type, path[1:])), F.lit(False))


def text_leaves(schema: T.StructType) -> list[Path]:
    """Paths of all text leaves of a table, top-level columns as 1-tuples."""
    return _leaves(schema)


def type_at(schema: T.DataType, path: Path) -> T.DataType | None:
    """The type at the end of a path; None where it leads nowhere."""
    for step in path:
        if step == ITEM and isinstance(schema, T.ArrayType):
            schema = schema.elementType
        elif step == VALUE and isinstance(schema, T.MapType):
            schema = schema.valueType
        elif isinstance(schema, T.StructType) and step in schema.names:
            schema = schema[step].dataType
        else:
            return None
    return schema


def narrow_metrics(df: DataFrame) -> list[Column]:
    """Aggregates deciding the narrowing of every text leaf (columns, struct
    fields, array elements, map values); usable in a ``df.agg`` or in the
    ``Observation`` of a write that scans the data anyway."""
    aggs = []
    for i, path in enumerate(text_leaves(df.schema)):
        c, dt = F.col(f"`{path[0]}`"), df.schema[path[0]].dataType
        is_date = lambda x: x.rlike(DATE_TEXT) & x.try_cast("date").isNotNull()
        is_ts = lambda x: x.rlike(TIMESTAMP_TEXT) & x.try_cast("timestamp_ntz").isNotNull()
        aggs += [
            F.bool_and(_every(c, dt, path[1:], is_date)).alias(f"_nd{i}"),
            F.bool_and(_every(c, dt, path[1:], is_ts)).alias(f"_nt{i}"),
            F.count_if(_some(c, dt, path[1:])).alias(f"_nn{i}"),
        ]
    return aggs


def plan_from_metrics(df: DataFrame, row) -> dict[Path, str]:
    """``{path: "date" | "timestamp_ntz"}`` from the ``narrow_metrics`` values."""
    plan = {}
    for i, path in enumerate(text_leaves(df.schema)):
        if not row[f"_nn{i}"]:
            continue
        if row[f"_nd{i}"]:
            plan[path] = "date"
        elif row[f"_nt{i}"]:
            plan[path] = "timestamp_ntz"
    return plan


def narrow_plan(df: DataFrame) -> dict[Path, str]:
    """Decide, in ONE aggregation job over all text leaves, which hold only
    dates or only timestamps (NULLs ignored; an all-NULL leaf stays text).

    Returns ``{path: "date" | "timestamp_ntz"}``.  The aggregate is a global
    ``bool_and`` with partial aggregation, so its result is one row.
    """
    aggs = narrow_metrics(df)
    if not aggs:
        return {}
    return plan_from_metrics(df, df.agg(*aggs).first())


def _rebuilt(c: Column, dt: T.DataType, plan: dict[Path, str]) -> Column:
    """``c`` with the leaves of ``plan`` (paths below ``c``) cast."""
    if () in plan:
        return c.cast(plan[()])
    if not plan:
        return c
    if isinstance(dt, T.StructType):
        below = {f.name: {p[1:]: t for p, t in plan.items() if p[0] == f.name} for f in dt.fields}
        whole = F.struct(*[_rebuilt(c.getField(f.name), f.dataType, below[f.name]).alias(f.name) for f in dt.fields])
        return F.when(c.isNotNull(), whole)
    rest = {p[1:]: t for p, t in plan.items()}
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda _, v: _rebuilt(v, dt.valueType, rest))
    return F.transform(c, lambda x: _rebuilt(x, dt.elementType, rest))


def apply_narrowing(df: DataFrame, plan: dict[Path, str]) -> DataFrame:
    out = []
    for f in df.schema.fields:
        mine = {p[1:]: t for p, t in plan.items() if p[0] == f.name}
        c = F.col(f"`{f.name}`")
        out.append(_rebuilt(c, f.dataType, mine).alias(f.name) if mine else c)
    return df.select(*out)


def narrow_types(df: DataFrame) -> DataFrame:
    """Narrow text leaves that hold only dates / timestamps (one scan to decide)."""
    return apply_narrowing(df, narrow_plan(df))
