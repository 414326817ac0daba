"""Line de-duplication: per-document keep bitmaps from sorted line hashes.

Method: lines are hashed; one row per (hash, document) is range-partitioned by
hash with a secondary order by document, the largest first, and position.  A
row's place in that stream (partition, then row) is its number; the row of a
hash with the least number is its first occurrence, and its document keeps the
line.  What comes back is a bitmap of dropped lines per document, in 64-bit
words of which the empty ones are left out; texts are only touched again when a
bitmap is applied.  Everything here is DataFrame code.

Skew: the range key goes on with the document, so a hash held by a third of all
documents covers many partitions; each streams to one partial row per hash (its
first number and a count) before the last, tiny exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    k1, k2 = common.row_key(id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(id_col).alias("_doc"),
                        F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"))
    key = F.btrim(common.ascii_lower(F.col("_line")), F.lit(common.BLANKS))
    return (lines.withColumn("_key", key).filter(F.length("_key") >= min_chars)
            .select("_k1", "_k2", "_doc", "_pos", F.xxhash64("_key").alias("_h1"),
                    F.xxhash64(F.lit(1), "_key").alias("_h2")))


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_h1, _h2, n_docs, keeper``: hashes of lines found in at least
    ``min_docs`` documents and the largest document id holding each.  All rows
    without an id count as one document, which never keeps a line."""
    per_doc = (_lines(docs, id_col, text_col, min_chars)
               .groupBy("_h1", "_h2", "_doc").agg(F.min("_pos").alias("_pos")))
    order = [F.col("_h1"), F.col("_h2"), F.col("_doc").desc_nulls_last(), F.col("_pos")]
    # The number depends on the order, so the sort stays in the plan.
    streamed = (per_doc.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_at", F.monotonically_increasing_id()))
    stats = streamed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n_docs"),
                                               F.min_by("_doc", "_at").alias("keeper"))
    return stats.filter(F.col("n_docs") >= min_docs)


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_k1, _k2, drop_words``: for each document (by row key) that loses
    lines, ``array<struct<word, bits>>`` with bit ``p % 64`` of word ``p / 64``
    set when line ``p`` goes.  Words without a bit are left out."""
    shared = common.saved(shared_lines(docs, id_col, text_col, min_chars, min_docs), "lines")
    gone = (_lines(docs, id_col, text_col, min_chars).join(shared, ["_h1", "_h2"])
            .filter(~F.col("_doc").eqNullSafe(F.col("keeper"))))
    words = (gone.select("_k1", "_k2", F.floor(F.col("_pos") / 64).cast("int").alias("word"),
                         F.expr("shiftleft(1L, _pos % 64)").alias("bit"))
             .groupBy("_k1", "_k2", "word").agg(F.bit_or("bit").alias("bits")))
    return words.groupBy("_k1", "_k2").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drop_words"))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_row`` (the row of ``docs``), ``_n_lines`` and ``_kept`` (the kept
    lines, in order).

    A null or empty text has one empty line.  Repeated rows share a row key and
    so a bitmap.  Columns of ``docs`` may have any names.
    """
    bitmaps = drop_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    # The words again without gaps, so that a line's bit is an array access.
    dense = F.expr("flatten(transform(drop_words, (e, j) -> concat(array_repeat(0L, "
                   "e.word - coalesce(get(drop_words, j - 1).word, -1) - 1), array(e.bits))))")
    bitmaps = bitmaps.select("_k1", "_k2", dense.alias("_drop"))
    joined = common.packed(docs, id_col, text_col).join(bitmaps.hint("shuffle_hash"), ["_k1", "_k2"], "left")
    lines = F.split(F.coalesce(F.col("_row").getField(text_col), F.lit("")), "\n", -1)
    kept = F.when(F.col("_drop").isNull(), lines).otherwise(F.filter(
        lines, lambda x, i: F.coalesce(
            F.getbit(F.get(F.col("_drop"), F.floor(i / 64).cast("int")), i % 64), F.lit(0)) == 0))
    return joined.select("_row", F.size(lines).alias("_n_lines"), kept.alias("_kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with shared lines taken out of the text.

    A line's key is the line stripped of blanks at both ends with A-Z
    lower-cased; keys of at least ``min_chars`` code points in at least
    ``min_docs`` documents stay only in the largest document id.  A null text
    stays null, columns and row count stay as they are.
    """
    out = kept_lines(docs, id_col, text_col, min_chars, min_docs)
    text = F.when(F.col("_row").getField(text_col).isNotNull(), F.array_join("_kept", "\n"))
    return common.unpacked(out, docs, **{text_col: text})


def op7_line_dedup(spark, sf_dir):
    out = kept_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", F.col("_n_lines").cast("long").alias("n_lines"),
                      (F.col("_n_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
                      F.sha2(F.array_join("_kept", "\n").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (
  SELECT rid, doc_id, u.pos, u.line,
         trim(translate(u.line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT row_number() OVER () AS rid, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       unnest(list_transform(ls, lambda x, i: {'pos': i, 'line': x})) AS t(u)
), s AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT coalesce(doc_id, -1)) >= 5
), m AS (
  SELECT l.*, s.k IS NOT NULL AND l.doc_id IS DISTINCT FROM s.keeper AS gone
  FROM l LEFT JOIN s ON l.k = s.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""
