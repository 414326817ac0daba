"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.session import delete_path, scratch_dir, ship_package

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"  # the bytes of [\x20\x09-\x0D]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable on Python workers of a cluster."""
    ship_package(spark)


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read
    it back: cuts the lineage at a point every executor can reach, so losing
    one never recomputes what lies before."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'llm-' + purpose)}/data"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_in = path
    return out


def discard(table_: DataFrame) -> None:
    """Delete a ``saved`` table that nothing reads any more: what was made of
    it must have been saved in turn."""
    delete_path(table_._saved_in, table_.sparkSession)


def row_key(*cols: str) -> tuple[Column, Column]:
    """A 128-bit key of a row's columns, as two longs.  Repeated rows share it;
    null ids and null texts have keys of their own."""
    cs = [F.col(c) for c in cols]
    return (F.xxhash64(*cs, *[c.isNull() for c in cs]),
            F.xxhash64(F.lit(1), *reversed(cs), *[c.isNull() for c in cs]))


def packed(docs: DataFrame, *key_cols: str) -> DataFrame:
    """``_row`` (all columns as a struct) with ``_k1, _k2``, the row key of
    ``key_cols``: names inside the struct clash with nothing added later."""
    k1, k2 = row_key(*key_cols)
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), k1.alias("_k1"), k2.alias("_k2"))


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``_row``, those in ``changed`` replaced."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("_row").getField(c).alias(c)
                         for c in docs.columns])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())
