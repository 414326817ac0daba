"""Row numbers within groups, without a window over a whole group.

Rows are range-partitioned and sorted by group and order, so a group of any
size covers as many partitions as it needs; a row's number is its place in its
partition plus the rows of its group in earlier partitions, which come from a
table of one row per group and partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm import common


def ranked(df: DataFrame, group: list[str], order: list[Column], purpose: str) -> DataFrame:
    """``df`` with ``_rank`` (from 0, by ``order`` within the group) and
    ``_size`` (rows of the group).  Null group values are a group.  ``order``
    should leave equal only rows that may change places."""
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    # A row's id holds its partition in the upper bits and its place below.
    laid = (df.repartitionByRange(*(keys or [F.lit(0)])).sortWithinPartitions(*keys)
            .withColumn("_at", F.monotonically_increasing_id()))
    laid = common.saved(laid, purpose).withColumn("_part", F.shiftright("_at", 33))
    runs = (laid.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"))
            .agg(F.count(F.lit(1)).alias("_k"), F.min("_at").alias("_from")))
    # A group has one row a partition here.
    mine = Window.partitionBy(*[f"_g{i}" for i in range(len(group))])
    before = F.sum("_k").over(mine.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("*", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_k").over(mine).alias("_size"))
    same = reduce(lambda a, b: a & b, [laid[g].eqNullSafe(runs[f"_g{i}"]) for i, g in enumerate(group)],
                  F.col("_part") == F.col("_p"))
    return laid.join(runs, same).select(
        *[F.col(c) for c in df.columns], (F.col("_at") - F.col("_from") + F.col("_before")).alias("_rank"), "_size")
