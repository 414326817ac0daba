"""Ledger: an append-only log, folded from time to time into a snapshot.

Writers append small files to ``<root>/ledger/kind=<k>``.  ``fold`` reads the
files there are, reduces their rows with what the snapshot already holds and
writes the result to ``<root>/ledger_snapshot/kind=<k>/day=<d>`` by dynamic
partition overwrite, so only the days the log touches are rewritten:

* a run is one row (first start, last finish, latest status) on the day it
  started;
* of checkpoints the latest run's are kept per client and table, of cursors the
  latest one;
* stage events are history: all of them stay, in few files.

One appended marker row then names the log files folded; they are deleted, and
until that has happened readers leave them out.  The reductions give the same
for a row seen twice (events are told apart by their identity), so a fold that
is cut off anywhere changes nothing a reader sees.  ``read`` is the snapshot
with the log's remaining files, its tail, on top.

One fold of a ledger runs at a time; a query of the ledger that is still
running while one of its days is rewritten fails and is asked again.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import delete_path, list_names, path_exists

MARKER_SCHEMA = "seq long, files string"
ANY_DAY = "any"     # the day of kinds that keep only their latest rows
EVENT_IDENTITY = ["run_id", "event_type", "stage", "created_at", "seq"]


class Ledger:
    """The log and its snapshot under one root; ``schema`` holds the columns
    of all kinds, ``kind`` among them."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark = spark
        self.log = f"{root}/ledger"
        self.snapshot = f"{root}/ledger_snapshot"
        self.markers = f"{root}/ledger_folds"
        self.schema = T.StructType([f for f in T.DataType.fromDDL(schema).fields if f.name != "kind"])
        self.columns = self.schema.names

    # ------------------------------------------------------------- reading
    def _files(self, kind: str) -> list[str]:
        folder = f"{self.log}/kind={kind}"
        return [f"{folder}/{n}" for n in list_names(folder, self.spark) if not n.startswith(("_", "."))]

    def _folded(self) -> set[str]:
        """Log files that the last fold took in and may not have deleted yet."""
        if not path_exists(self.markers, self.spark):
            return set()
        last = (self.spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true").parquet(self.markers)
                .agg(F.max_by("files", "seq")).first()[0])
        return set(json.loads(last)) if last else set()

    def _parquet(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.columns)

    def tail(self, kind: str) -> DataFrame:
        """Log rows that are not in the snapshot."""
        files = self._files(kind)
        gone = self._folded() if files else set()
        return self._parquet([f for f in files if f not in gone])

    def settled(self, kind: str) -> DataFrame:
        folder = f"{self.snapshot}/kind={kind}"
        return self._parquet([folder] if path_exists(folder, self.spark) else [])

    def read(self, kind: str) -> DataFrame:
        """All that the ledger knows of a kind, in its columns: for runs,
        checkpoints and cursors rows whose fold is the state."""
        rows = self.settled(kind).unionByName(self.tail(kind))
        return rows.dropDuplicates(EVENT_IDENTITY) if kind == "event" else rows

    # ------------------------------------------------------------- folding
    def _reduced(self, kind: str, rows: DataFrame) -> DataFrame:
        if kind == "run":
            known = F.when(F.col("stage").isNotNull(), F.col("seq"))
            folds: dict[str, Column] = {
                "started_at": F.min("started_at"), "finished_at": F.max("finished_at"),
                "created_at": F.min("created_at"), "seq": F.max("seq"), "status": F.max_by("status", "seq"),
                "error": F.max_by("error", "seq"), "stage": F.max_by("stage", known),
                "records_in": F.max("records_in"), "records_out": F.max("records_out"),
                "client": F.max_by("client", F.when(F.col("client").isNotNull(), F.col("seq"))),
                "pipeline": F.max_by("pipeline", F.when(F.col("pipeline").isNotNull(), F.col("seq")))}
            out = rows.groupBy("run_id").agg(*[c.alias(n) for n, c in folds.items()])
            return out.select(*[F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                for f in self.schema.fields])
        if kind in ("checkpoint", "cursor"):
            row = F.struct(*self.columns)
            key = ["client", "pipeline"]
            if kind == "cursor":
                return rows.groupBy(*key).agg(F.max_by(row, "seq").alias("r")).select("r.*")
            # The latest run's stages: what a resume asks for.
            latest = (rows.groupBy(*key, "run_id", "stage").agg(F.max_by(row, "seq").alias("r"))
                      .groupBy(*key, "run_id").agg(F.max("r.seq").alias("at"), F.collect_list("r").alias("rs"))
                      .groupBy(*key).agg(F.max_by("rs", "at").alias("rs")))
            return latest.select(F.explode("rs").alias("r")).select("r.*")
        return rows.dropDuplicates(EVENT_IDENTITY)

    def _day(self, kind: str) -> Column:
        if kind not in ("run", "event"):
            return F.lit(ANY_DAY)
        at = F.coalesce("started_at", "created_at") if kind == "run" else F.col("created_at")
        return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(ANY_DAY))

    def _fold_kind(self, kind: str, files: list[str]) -> None:
        fresh = self._parquet(files)
        old = self.spark.createDataFrame([], self.schema)
        if path_exists(f"{self.snapshot}/kind={kind}", self.spark):
            dated = T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])
            base = self.spark.read.schema(dated).parquet(f"{self.snapshot}/kind={kind}")
            # The days the log touches: one value a day.
            touched = fresh.select(self._day(kind).alias("day"))
            if kind == "run":
                touched = touched.unionByName(base.join(fresh.select("run_id").distinct(), "run_id", "left_semi").select("day"))
            days = [r[0] for r in touched.distinct().collect()]
            old = base.where(F.col("day").isin(days)).select(*self.columns)
        rows = self._reduced(kind, old.unionByName(fresh)).withColumn("day", self._day(kind))
        # A task or a few per day; an outsize day is split at runtime.
        (rows.withColumn("kind", F.lit(kind)).hint("rebalance", F.col("day")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "day").parquet(self.snapshot))

    def fold(self) -> int:
        """Take the log's files into the snapshot; the number of files."""
        for path in self._folded():  # of a fold that ended before its deletions
            delete_path(path, self.spark)
        kinds = [n.split("=", 1)[1] for n in list_names(self.log, self.spark) if n.startswith("kind=")]
        taken: list[str] = []
        for kind in kinds:
            files = self._files(kind)
            if files:
                self._fold_kind(kind, files)
                taken += files
        if not taken:
            return 0
        marker = f"{self.markers}/fold-{uuid.uuid4().hex[:12]}"
        older = [n for n in list_names(self.markers, self.spark) if n.startswith("fold-")]
        (self.spark.createDataFrame([(time.time_ns(), json.dumps(taken))], MARKER_SCHEMA).coalesce(1)
         .write.parquet(marker))
        for path in taken:
            delete_path(path, self.spark)
        for name in older:  # their files are gone
            delete_path(f"{self.markers}/{name}", self.spark)
        return len(taken)
