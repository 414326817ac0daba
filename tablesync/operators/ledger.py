"""Queries over the run ledger, checkpoints, stage events and page ledger.

All state tables are append-only; "current" state is the latest row per key,
computed with ``max_by`` aggregates (partial aggregation, bounded state per
key, so a hot key costs nothing extra).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.functions.clean import parse_total

# Stage order of a sync run, and where a resumed run continues.
STAGE_ORDER = ["EXTRACT", "VALIDATE", "LOAD", "VERIFY"]
# A completed run (last stage VERIFY) starts a fresh run at EXTRACT.
NEXT_STAGE = {"EXTRACT": "VALIDATE", "VALIDATE": "LOAD", "LOAD": "VERIFY", "VERIFY": "EXTRACT"}

TOP_RUNS = 20


# --------------------------------------------------------------------- runs
def status_top(runs: DataFrame, client: str | None = None, n: int = TOP_RUNS) -> DataFrame:
    """Last ``n`` runs (optionally of one client), newest first; ties by run_id."""
    if client is not None:
        runs = runs.where(F.col("client") == client)
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def failed_on_day(runs: DataFrame, day: str | None = None) -> DataFrame:
    """Failed runs of one day; ``day=None`` means the latest day in the ledger
    (the ledger's "today").  The latest day is a one-row aggregate joined back
    with a broadcast -- its size is one row by construction."""
    failed = runs.where(F.col("status") == "FAILED").withColumn("_day", F.to_date("started_at"))
    if day is not None:
        return failed.where(F.col("_day") == F.lit(day).cast("date")).drop("_day")
    today = runs.agg(F.max(F.to_date("started_at")).alias("_day"))
    return failed.join(F.broadcast(today), on="_day").drop("_day")


def volume_by_day(runs: DataFrame) -> DataFrame:
    """max(records_out) of successful runs per pipeline and day."""
    return (runs.where(F.col("status") == "SUCCESS")
            .groupBy("pipeline", F.to_date("started_at").alias("day"))
            .agg(F.max("records_out").alias("rows")))


def run_summary(results: DataFrame, run_keys: Sequence[str] = ("client", "started_at"),
                stream: str = "pipeline", status: str = "status",
                loaded: str = "records_out") -> DataFrame:
    """Per client run: overall status plus the per-stream list as JSON.

    Streams are first reduced per (run, stream) -- a partial aggregate -- so
    the list collected per run has one entry per distinct stream, bounded by
    the catalog size however many rows a run key carries.
    """
    keys = list(run_keys)
    failed = F.col(status) == "FAILED"
    with_error = "error" in results.columns
    per_stream = (results.groupBy(*keys, F.col(stream).alias("stream"))
                  .agg(F.max(failed.cast("int")).alias("_f"),
                       F.sum(loaded).cast("long").alias("records_loaded"),
                       F.count(F.lit(1)).alias("runs"),
                       *([F.max("error").alias("error")] if with_error else [])))
    entry = F.struct(
        F.col("stream"),
        F.when(F.col("_f") == 1, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.col("records_loaded"), F.col("runs"), *([F.col("error")] if with_error else []))
    return (per_stream.groupBy(*keys)
            .agg(F.max("_f").alias("_f"), F.sort_array(F.collect_list(entry)).alias("_s"),
                 F.sum("records_loaded").cast("long").alias("records_loaded"))
            .select(*keys,
                    F.when(F.col("_f") == 1, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
                    "records_loaded",
                    F.to_json("_s").alias("streams")))


def dead_letters_latest(dead: DataFrame, runs: DataFrame, client: str | None = None) -> DataFrame:
    """Dead letters of each client's latest run (one client when given), newest first."""
    if client is not None:
        runs = runs.where(F.col("client") == client)
    # One row per client: small by construction, and the join that prunes dead
    # letters to the runs asked for comes before anything is done to them.
    latest = runs.groupBy("client").agg(F.max("run_id").alias("run_id"))
    order = [F.col("created_at").desc()] + ([F.col("id").desc()] if "id" in dead.columns else [])
    return dead.join(latest, on="run_id").orderBy(*order)


def run_fold(ledger: DataFrame) -> DataFrame:
    """Fold start/finish rows per run: first start, last finish, latest status
    (plus pipeline, latest stage and error when the ledger carries them)."""
    extra = []
    if "pipeline" in ledger.columns:
        extra.append(F.first("pipeline", ignorenulls=True).alias("pipeline"))
    if "stage" in ledger.columns:
        extra.append(F.max_by("stage", F.when(F.col("stage").isNotNull(), F.col("seq"))).alias("stage"))
    if "error" in ledger.columns:
        extra.append(F.max_by("error", "seq").alias("error"))
    agg = ledger.groupBy("run_id").agg(
        F.first("client", ignorenulls=True).alias("client"),
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.max_by("status", "seq").alias("status"),
        F.max("records_out").alias("records_out"),
        *extra,
    )
    # Wall-clock difference, independent of the session time zone.
    dur = F.expr("timestampdiff(MICROSECOND, started_at, finished_at)") / F.lit(1_000_000.0)
    return agg.withColumn("duration_s", dur)


def event_counts(events: DataFrame) -> DataFrame:
    """Stage events per (event_type, stage): count and records sum."""
    return events.groupBy("event_type", "stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("records").cast("long").alias("records"))


# -------------------------------------------------------------- checkpoints
def checkpoint_latest(log: DataFrame, keys: Sequence[str] = ("client", "pipeline")) -> DataFrame:
    """Current checkpoint per key: the latest row by ``seq``; a tombstone
    (``cleared``) as the latest row means the checkpoint was cleared."""
    keys = list(keys)
    payload = [c for c in log.columns if c not in keys]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col("seq")).alias("_l"))
    return latest.where(~F.col("_l.cleared")).select(*keys, *[F.col(f"_l.{c}").alias(c)
                                                            for c in payload if c != "cleared"])


def resume_point(latest: DataFrame, stage: str = "stage") -> DataFrame:
    """Where a resumed run continues, from the current checkpoint per key."""
    nxt = F.create_map(*[x for k, v in NEXT_STAGE.items() for x in (F.lit(k), F.lit(v))])
    return latest.withColumn("resume_stage",
                             F.coalesce(F.element_at(nxt, F.col(stage)), F.lit(STAGE_ORDER[0])))


# -------------------------------------------------------------- page ledger
def page_ledger(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per fetched page: endpoint, page, record count, parsed total,
    and when it was fetched, where ``pages`` tells."""
    parsed = F.from_json(F.col(body), "registros array<string>, total string")
    clock = ["fetched_at"] if "fetched_at" in pages.columns else []
    return (pages.select("endpoint", "page", *clock, parsed.alias("_p"))
            .where(F.size("_p.registros") > 0)
            .select("endpoint", F.col("page").cast("long").alias("page"),
                    F.size("_p.registros").cast("long").alias("n_records"),
                    parse_total(F.col("_p.total")).alias("total"), *clock))


def page_progress(ledger: DataFrame, page_size: int) -> DataFrame:
    """Cumulative fetched rows, percent done (1 decimal) and total pages.

    The page ledger has one row per page, so an endpoint's rows are bounded by
    the page cap and one window per endpoint is enough."""
    total = F.col("total")
    upto = Window.partitionBy("endpoint").orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ledger.withColumn("fetched", F.sum("n_records").over(upto).cast("long"))
            .withColumn("pct", F.when(total > 0, F.round(F.col("fetched") / total * 100, 1)))
            .withColumn("total_pages",
                        F.when(total > 0, F.ceil(total / F.lit(page_size)).cast("long"))))


def page_elapsed(progress: DataFrame, at: str = "fetched_at") -> DataFrame:
    """``elapsed_s``: seconds from an endpoint's first fetch until the pages up
    to this one were all there (ranges are fetched in parallel, so a later page
    may come earlier)."""
    mine = Window.partitionBy("endpoint")
    upto = mine.orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    micros = F.timestamp_diff("MICROSECOND", F.min(at).over(mine), F.max(at).over(upto))
    return progress.withColumn("elapsed_s", micros / F.lit(1_000_000.0))


def page_eta(progress: DataFrame, elapsed: str = "elapsed_s") -> DataFrame:
    """Seconds left ``elapsed / fetched * (total - fetched)``; NULL once done.
    Without ``elapsed`` it is measured by ``page_elapsed``."""
    if elapsed not in progress.columns:
        progress = page_elapsed(progress).withColumnRenamed("elapsed_s", elapsed)
    f, t = F.col("fetched").cast("double"), F.col("total").cast("double")
    running = (F.col("total") > 0) & (F.col("fetched") > 0) & (F.col("fetched") < F.col("total"))
    return progress.withColumn("eta_s", F.when(running, F.col(elapsed).cast("double") / f * (t - f)))


# ------------------------------------------------------------- verification
def verify_counts(checked: DataFrame, loaded: DataFrame, stream: str = "stream",
                  valid: str | None = "valid") -> DataFrame:
    """Per stream: extracted, expected (the rows flagged ``valid``, or all
    without a contract), loaded and the verdict.

    ``checked`` has one row per extracted row, ``loaded`` the rows found in the
    target; each is read once and summed before the join of two small tables."""
    flag = F.sum(F.col(valid).cast("long")) if valid else F.count(F.lit(1))
    out = (checked.groupBy(stream).agg(F.count(F.lit(1)).alias("extracted"), flag.alias("expected"))
           .join(loaded.groupBy(stream).agg(F.count(F.lit(1)).alias("loaded")), on=stream, how="left")
           .withColumn("loaded", F.coalesce(F.col("loaded"), F.lit(0))))
    ok = ~((F.col("extracted") > 0) & (F.col("loaded") == 0)) & (F.col("loaded") == F.col("expected"))
    return out.select(stream, "extracted", F.coalesce("expected", F.lit(0)).cast("long").alias("expected"), "loaded",
                      F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"))
