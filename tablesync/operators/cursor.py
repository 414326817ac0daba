"""Incremental cursor: advance, look up, filter, default look-back."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The source's wall-clock zone and cursor text format.
SOURCE_TIME_ZONE = "America/Sao_Paulo"
CURSOR_TEXT = "yyyy-MM-dd HH:mm:ss"


def cursor_candidate(key: Column | str, numeric: bool = False) -> Column:
    """Aggregate: the largest raw key value, NULL and '' ignored.

    Text keys compare as text (code-point order); ``numeric=True`` compares
    numerically and returns the winning value as text.
    """
    c = F.col(key) if isinstance(key, str) else key
    text = F.nullif(c.cast("string"), F.lit(""))
    if numeric:
        return F.max_by(text, text.try_cast("decimal(38,10)"))
    return F.max(text)


def advance(current: str | None, candidate: Column) -> Column:
    """max(current, candidate); either side may be NULL."""
    if current is None:
        return candidate
    return F.greatest(F.lit(current), candidate)


def cursor_max(df: DataFrame, key: str, group_cols: Sequence[str] = (),
               current: str | None = None, numeric: bool = False,
               out: str = "cursor") -> DataFrame:
    """New cursor per group (partial aggregation: bounded state per group)."""
    cand = cursor_candidate(key, numeric).alias("_cand")
    agg = df.groupBy(*group_cols).agg(cand) if group_cols else df.agg(cand)
    if numeric and current is not None:
        new = F.when(F.col("_cand").isNull() | (F.col("_cand").try_cast("double")
                                                 < F.lit(current).try_cast("double")),
                     F.lit(current)).otherwise(F.col("_cand"))
    else:
        new = advance(current, F.col("_cand"))
    return agg.select(*group_cols, new.alias(out))


def cursor_lookup(cursor_log: DataFrame, keys: Sequence[str] = ("client", "pipeline"),
                  value: str = "value", seq: str = "seq") -> DataFrame:
    """Latest saved cursor per key from an append-only log."""
    return cursor_log.groupBy(*keys).agg(F.max_by(F.col(value), F.col(seq)).alias("cursor"))


def delta_filter(df: DataFrame, key: str, since: str | None, numeric: bool = False) -> DataFrame:
    """Incremental predicate ``key >= since`` (inclusive; the upsert is idempotent);
    ``numeric`` compares as numbers (a text key holding numbers included)."""
    if since is None:
        return df
    if numeric:
        # Decimals: keys beyond 2^53 stay apart.
        number = "decimal(38,10)"
        return df.where(F.col(key).cast("string").try_cast(number) >= F.lit(since).try_cast(number))
    return df.where(F.col(key) >= F.lit(since))


def is_number(value: str) -> bool:
    """Whether a saved cursor can bound a numeric key."""
    try:
        return math.isfinite(float(value))
    except ValueError:
        return False


def default_lookback(now: Column | str) -> Column:
    """Yesterday 00:00:00 in the source's zone, as cursor text, for a given
    'now' given as a UTC wall-clock ``timestamp_ntz`` (independent of the
    session time zone)."""
    c = F.col(now) if isinstance(now, str) else now
    local = F.convert_timezone(F.lit("UTC"), F.lit(SOURCE_TIME_ZONE), c.cast("timestamp_ntz"))
    return F.date_format(F.date_sub(F.to_date(local), 1), CURSOR_TEXT)
