"""Mixing sources to target weights with hash-threshold histograms.

Method: every document has a 60-bit hash; tokens are summed by source and hash
bucket, the bucket in which a source's budget ends is found, and only that
bucket is refined with the next bits of the hash until it holds one document.
A document is then taken by comparing its hash with its source's threshold: no
sort, and a larger budget always takes a superset.

Only the histogram leaves a task (sums are combined before the shuffle, at most
1024 rows per source and task), so a hot source costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm import common

HASH_BITS = 60
LEVEL_BITS = 10
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``id, source, size, _h``: size is the number of words (null text: 0),
    ``_h`` a hash of id and text, so reruns agree and repeated rows go alike."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    text_hash = F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.md5(F.concat(ident, F.lit("|"), text_hash).cast("binary"))
    h = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       size.alias("size"), h.alias("_h"))


def targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
            max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    ``total_share`` of all words.  A target stops at ``max_repeats`` times its
    source; the excess goes to the others by weight.  That fixed point is
    ``min(cap, level * weight)`` for one level, found by walking the sources by
    cap per weight.  One row per source: a window over them is a small table.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    src = src.withColumn("_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    src = src.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    walk = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(walk.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * F.lit(float(total_share))
    src = src.withColumn("_level", (total - before) / left)
    # The first source that its level does not push over the cap sets the level.
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_cap") / F.col("_w"))
    src = src.withColumn("_at", F.min(fits).over(everything))
    level = F.min(F.when(fits.isNotNull() & (fits == F.col("_at")), F.col("_level"))).over(everything)
    return src.select("source", "source_size",
                      F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap"))).alias("target"))


def thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """``source, source_size, target, _times, _cut``: every document is taken
    ``_times`` times and once more if its hash is below ``_cut``.

    Each level sums words by source and the next 10 hash bits inside the bucket
    left over, and keeps the bucket in which the budget ends.  The last bucket
    (one document, or rows with one hash) is taken when that ends nearer to the
    target than leaving it.
    """
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("_times", times.cast("long"))
    goal = common.saved(goal.withColumn(
        "_need", F.col("target") - F.col("_times") * F.col("source_size")), "mix-goal")
    state = goal.select("source", F.lit(0).cast("long").alias("_prefix"), F.col("_need").alias("_rest"))
    by_bucket = Window.partitionBy("source").orderBy("_b")
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        s = state.select(F.col("source").alias("_s"), "_prefix", "_rest")
        inside = sizes.join(s, sizes["source"].eqNullSafe(s["_s"])
                            & (F.shiftright("_h", shift + LEVEL_BITS) == F.col("_prefix")))
        hist = (inside.groupBy("source", F.shiftright("_h", shift).alias("_b"))
                .agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.first("_rest").alias("_rest")))
        upto = F.sum("_sum").over(by_bucket)
        hist = hist.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_rest"))
        first = hist.groupBy("source").agg(F.min_by(F.struct("_b", "_sum", "_n", "_upto", "_rest"), "_b").alias("x"))
        state = common.saved(first.select(
            "source", F.col("x._b").alias("_prefix"), F.col("x._sum").alias("_sum"), F.col("x._n").alias("_n"),
            (F.col("x._rest") - (F.col("x._upto") - F.col("x._sum"))).alias("_rest")), "mix-level")
        if not state.filter(F.col("_n") > 1).limit(1).count():
            break
    edge = F.expr(f"shiftleft(_prefix + IF(_sum <= 2 * _rest, 1L, 0L), {shift})")
    cuts = state.select(F.col("source").alias("_s"), edge.alias("_cut"))
    # A budget that no bucket exceeds takes the whole source.
    return (goal.join(cuts, goal["source"].eqNullSafe(cuts["_s"]), "left")
            .select("source", "source_size", "target", "_times",
                    F.coalesce("_cut", F.lit(1 << HASH_BITS)).alias("_cut")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``
    (``taken``: words the mix takes, 0, 1 or 2 times the size).

    Null texts have size 0, rows without a source are a source of their own,
    repeated rows are decided alike, an empty table gives no rows; other
    columns are not read.
    """
    sizes = common.saved(sized(docs, id_col, text_col, source_col), "mix-sizes")
    cut = thresholds(sizes, targets(sizes, weights, total_share, max_repeats))
    cut = common.saved(cut.withColumnRenamed("source", "_s"), "mix-cuts")
    joined = sizes.join(cut, sizes["source"].eqNullSafe(cut["_s"]))
    copies = F.col("_times") + F.when(F.col("_h") < F.col("_cut"), 1).otherwise(0)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def op4_mix_sources(spark, sf_dir):
    return mix(common.table(spark, sf_dir, "documents"))


def mix_sql(docs: str = "documents") -> str:
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 1, 15) AS h
  FROM {docs}
), s AS (
  SELECT source, sum(size)::BIGINT AS ss,
         [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source
), fill AS (
  SELECT 0 AS step, source, ss, w, 2.0::DOUBLE * ss AS cap, false AS full_
  FROM s
  UNION ALL
  SELECT step + 1, source, ss, w, cap,
         full_ OR w * (1.5::DOUBLE * sum(ss) OVER () - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0))
                  / nullif(sum(w) FILTER (WHERE NOT full_) OVER (), 0) > cap
  FROM fill WHERE step < (SELECT count(*) FROM s)
), done AS (
  SELECT source, ss, CASE WHEN full_ THEN cap ELSE
           w * (1.5::DOUBLE * sum(ss) OVER () - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0))
             / nullif(sum(w) FILTER (WHERE NOT full_) OVER (), 0) END AS target
  FROM fill WHERE step = (SELECT count(*) FROM s)
), t AS (
  SELECT d.doc_id, d.size, done.ss AS source_size, done.target,
         CASE WHEN done.ss > 0 THEN floor(done.target / done.ss) ELSE 0 END AS times,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS same
  FROM d JOIN done ON d.source IS NOT DISTINCT FROM done.source
)
SELECT doc_id, size, source_size, target,
       (size * (times + CASE WHEN upto + (upto - same) <= 2 * (target - times * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM t
"""


OP4_SQL = mix_sql()
