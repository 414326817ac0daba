"""Running totals and row ordinals per group without one-task windows.

``Window.partitionBy(group).orderBy(x)`` puts a whole group in one task; with
one group holding a third of the rows that task is the job.  Here the order
key is cut into fixed-width blocks: a window runs inside each (group, block)
-- at most ``2**block_bits`` rows when the order key is unique -- and a small
per-block sum table supplies each block's offset.  By default the width is
about the square root of the key range, balancing the two.  The big side is shuffled
once by (group, block) and the join to the offsets reuses that partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_bits_for(df: DataFrame, order: str) -> int:
    """Block width (bits) ~ sqrt of the order key's range: per-block windows
    and the per-group offset table both hold about sqrt(range) rows.  One
    min/max aggregate."""
    row = df.agg(F.min(F.col(order).cast("long")).alias("lo"),
                 F.max(F.col(order).cast("long")).alias("hi")).first()
    if row is None or row["lo"] is None:
        return 4
    span = int(row["hi"]) - int(row["lo"]) + 1
    return max(4, math.ceil(math.log2(span + 1) / 2))


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column,
                  out: str, descending: bool = False, total_col: str | None = None,
                  block_bits: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows of the same ``keys`` up to and
    including this one in ``order`` (ties broken arbitrarily, as row frames do).

    ``order`` must be an integral column.  ``total_col`` adds the group total.
    ``block_bits=None`` sizes the blocks from the key range (``block_bits_for``).
    """
    keys = list(keys)
    if block_bits is None:
        block_bits = block_bits_for(df, order)
    o = F.col(order).cast("long")
    o = -o if descending else o
    work = df.withColumns({"_ord": o, "_v": value})
    work = work.withColumn("_blk", F.shiftright(F.col("_ord"), block_bits))

    blocks = work.groupBy(*keys, "_blk").agg(F.sum("_v").alias("_bsum"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = blocks.withColumn("_off", F.coalesce(F.sum("_bsum").over(before), F.lit(0)))
    if total_col:
        offs = offs.withColumn(total_col, F.sum("_bsum").over(Window.partitionBy(*keys)))
    offs = offs.drop("_bsum")

    inside = (Window.partitionBy(*keys, "_blk").orderBy("_ord")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = work.withColumn("_local", F.sum("_v").over(inside))
    return (local.join(offs, on=[*keys, "_blk"])
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_ord", "_v", "_blk", "_off", "_local"))


def row_ordinal(df: DataFrame, keys: Sequence[str], order: str, out: str,
                descending: bool = False, total_col: str | None = None,
                block_bits: int | None = None) -> DataFrame:
    """1-based row number per group in ``order`` (unique order key expected)."""
    return running_total(df, keys, order, F.lit(1).cast("long"), out,
                         descending=descending, total_col=total_col, block_bits=block_bits)
