"""Incremental sync as Structured Streaming micro-batches.

``readStream`` over landing files or the paged source -> ``foreachBatch``:
clean the batch, stage it as parquet (read several times below) and publish it
as a keyed delta of the table, which rewrites the key buckets it touches.  The
one pointer row that publishes a batch names its query and batch id, so a
replay after a crash finds the batch published and changes nothing, and
another query -- or the same one with a new checkpoint folder -- has ids of
its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.functions.clean import sanitize, strip_nul_all
from tablesync.operators.upsert import key_bytes
from tablesync.plans.publish import TableStore
from tablesync.session import delete_path

# Set by Spark on the thread that runs a micro-batch.
QUERY_ID = "sql.streaming.queryId"


def make_batch_upsert(spark: SparkSession, table: str, pk, store: TableStore, query_id: str | None = None):
    """The ``foreachBatch`` function for one target table.  ``query_id``
    names the stream where none runs (tests)."""
    first = True

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal first
        query = query_id or batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if not query:
            raise RuntimeError("no streaming query runs this batch: pass query_id")
        run_id = f"{query}:{batch_id}"
        # Only the first batch after a start can be a replay.
        if first and store.published(table, run_id):
            first = False
            return
        first = False
        stage = f"{store.root}/_staging/{table}/batch={batch_id}-{uuid.uuid4().hex[:8]}"
        obs = Observation(f"batch_{table}_{batch_id}")
        cleaned = strip_nul_all(sanitize(batch))
        cleaned.observe(obs, F.count(F.lit(1)).alias("n"), key_bytes(pk).alias("kb")) \
            .write.mode("errorifexists").parquet(stage)
        rows = int(obs.get["n"])
        if rows:
            staged = spark.read.schema(cleaned.schema).parquet(stage)
            store.publish_delta(table, staged, pk, run_id, rows, rows, int(obs.get["kb"] or 0))
        delete_path(stage, spark)

    return apply


def start_stream_upsert(spark: SparkSession, source: DataFrame, table: str, pk, store: TableStore,
                        checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = (source.writeStream.foreachBatch(make_batch_upsert(spark, table, pk, store))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_stream_upsert(spark: SparkSession, path: str, schema: str, table: str, pk,
                      store: TableStore, checkpoint: str, files_per_batch: int | None = None,
                      fmt: str = "parquet") -> None:
    """Drain every file under ``path`` (availableNow) into ``table``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    drain(spark, reader.load(path), table, pk, store, checkpoint)


def drain(spark: SparkSession, source: DataFrame, table: str, pk, store: TableStore, checkpoint: str) -> None:
    """Upsert all that ``source`` has now (availableNow) and stop."""
    q = start_stream_upsert(spark, source, table, pk, store, checkpoint)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
