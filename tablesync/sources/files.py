"""NDJSON landing files and staged parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.types import narrow_types


def ndjson_scan(spark: SparkSession, path: str, schema=None, narrow: bool = True) -> DataFrame:
    """Read NDJSON.  With a schema nothing is inferred (the cheap path at scale);
    without one Spark infers it (one extra pass) and date / timestamp text
    columns are narrowed in one more aggregate pass."""
    reader = spark.read
    if schema is not None:
        return reader.schema(schema).json(path)
    df = reader.json(path)
    return narrow_types(df) if narrow else df


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_staged(df: DataFrame, path: str) -> None:
    """Stage rows, replacing what an earlier attempt left."""
    df.write.mode("overwrite").parquet(path)


def staged_scan(spark: SparkSession, path: str) -> DataFrame:
    """All staged rows of one run (parquet keeps the schema even when empty)."""
    return spark.read.parquet(path)
