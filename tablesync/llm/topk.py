"""Exact top-k inner-product search with one KD-tree per shard of vectors.

Method: each task cuts its rows into shards, builds a KD-tree over a shard by
median splits on the widest side, keeps a tight bounding box per node, and
searches best-first: nodes are visited by the upper bound of the inner product
between the query and the node's box, and a search ends when the best open bound
is below the k-th score so far.  That k-th score is carried from shard to shard
of a task.  Each task returns at most k rows per query, and a window over
those gives the answer.

Queries are handed out in blocks of a fixed number of rows; every block sees
all rows.  The driver holds one block at a time: it is broadcast alone, its
answers are written and it is released before the next.  Scores are integers,
so results are exact.  Components must keep inner products within 64 bits: with
``d`` components, each below ``2**31 / (256 * sqrt(d))`` is enough; beyond that
the query fails rather than wrap.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm import common

QUERY_BLOCK = 4096   # queries per broadcast: 2 MB at 64 components
SHARD_ROWS = 8192    # vectors per KD-tree
LEAF_ROWS = 128


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v``: rows with an id whose vector and components are neither
    null nor non-finite, each component as floor(256 x) in doubles."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    ok = x.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.col(id_col).isNotNull()
    return vectors.filter(ok).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * 256).cast("long")).alias("v"))


def build_tree(m: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """``(order, lo, hi, first, last, left)``: node boxes, row ranges of
    ``order`` and left children (-1: leaf; the right child is the next)."""
    order = np.arange(len(m))
    lo, hi, first, last, left = [], [], [], [], []

    def add(a, b):
        rows = m[order[a:b]]
        lo.append(rows.min(axis=0))
        hi.append(rows.max(axis=0))
        first.append(a)
        last.append(b)
        left.append(-1)
        return len(first) - 1

    open_nodes = [add(0, len(m))]
    while open_nodes:
        n = open_nodes.pop()
        a, b = first[n], last[n]
        width = hi[n] - lo[n]
        side = int(width.argmax()) if len(width) else 0
        if b - a <= leaf_rows or not len(width) or width[side] == 0:
            continue  # small, or all rows equal
        mid = (a + b) // 2
        part = order[a:b]
        order[a:b] = part[np.argpartition(m[part, side], mid - a)]
        left[n] = add(a, mid)
        open_nodes += [left[n], add(mid, b)]
    return order, np.array(lo), np.array(hi), first, last, left


class Best:
    """The k best (score, -vec_id) of one query; ties go to the smaller id."""

    __slots__ = ("k", "heap")

    def __init__(self, k):
        self.k, self.heap = k, []

    def kth(self):
        return self.heap[0][0] if len(self.heap) == self.k else None

    def offer(self, scores, ids, own):
        if len(self.heap) == self.k:
            keep = scores >= self.heap[0][0]
            scores, ids = scores[keep], ids[keep]
        if len(scores) > self.k + 1:  # one more, for the query itself
            top = np.lexsort((ids, -scores))[:self.k + 1 if (ids == own).sum() <= 1 else None]
            scores, ids = scores[top], ids[top]
        for s, i in zip(scores.tolist(), ids.tolist()):
            if i == own:
                continue
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (s, -i))
            elif (s, -i) > self.heap[0]:
                heapq.heapreplace(self.heap, (s, -i))


def search(tree, m, ids, queries, query_ids, best):
    """Best-first search of one tree for every query; ``best`` is updated."""
    order, lo, hi, first, last, left = tree
    if m.shape[1] and float(np.abs(m).max()) * float(np.abs(queries).max()) * m.shape[1] >= 2.0 ** 63:
        raise OverflowError("inner products of these vectors may pass 64 bits")
    bounds = np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T
    for q, b, own, row in zip(queries, best, query_ids, bounds):
        heap = [(-int(row[0]), 0)]
        while heap:
            bound, n = heapq.heappop(heap)
            kth = b.kth()
            if kth is not None and -bound < kth:
                break
            if left[n] < 0:
                rows = order[first[n]:last[n]]
                b.offer(m[rows] @ q, ids[rows], own)
            else:
                for child in (left[n], left[n] + 1):
                    if kth is None or row[child] >= kth:
                        heapq.heappush(heap, (-int(row[child]), child))


def _task(batches, query_ids, queries, k, shard_rows, leaf_rows):
    best = [Best(k) for _ in query_ids]
    held, n = [], 0

    def flush():
        rows = [v for vs, _ in held for v in vs]
        ids = np.concatenate([i for _, i in held])
        dims = np.array([len(r) for r in rows])
        for dim in np.unique(dims):  # vectors meet those of their own length
            at = np.flatnonzero(dims == dim)
            mine = [j for j, q in enumerate(queries) if len(q) == dim]
            if not mine:
                continue
            m = np.array([rows[j] for j in at], dtype=np.int64).reshape(len(at), dim)
            search(build_tree(m, leaf_rows), m, ids[at], np.array([queries[j] for j in mine], dtype=np.int64)
                   .reshape(len(mine), dim), [query_ids[j] for j in mine], [best[j] for j in mine])

    for pdf in batches:
        held.append((list(pdf["v"]), pdf["vec_id"].to_numpy()))
        n += len(pdf)
        if n >= shard_rows:
            flush()
            held, n = [], 0
    if n:
        flush()
    out = [(q, -i, s) for q, b in zip(query_ids, best) for s, i in b.heap]
    if out:
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          query_block: int = QUERY_BLOCK, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row matching ``is_query`` the
    ``k`` rows with the highest integer inner product, its own id left out, ties
    to the smaller id; fewer than ``k`` candidates are all returned.

    Rows without an id, null vectors and vectors with a null or non-finite
    component take no part; vectors of different lengths never meet.  Repeated
    rows are candidates each; a repeated query is asked once per distinct
    vector.  No queries or no rows: an empty result.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    rows = usable(vectors, id_col, vec_col)
    asked = rows.filter(is_query(F.col("vec_id"))).distinct().sort("vec_id", "v")
    schema = "query_id long, vec_id long, score long"
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))

    def first(found):
        return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    def run(block):
        """The answers to a block, and the broadcast they still need."""
        held = spark.sparkContext.broadcast(([r[0] for r in block], [tuple(r[1]) for r in block]))

        def task(batches):
            yield from _task(batches, *held.value, k, shard_rows, leaf_rows)

        return first(rows.mapInPandas(task, schema)), held

    def written(block):
        found, held = run(block)
        found = common.saved(found, "topk-block")
        held.destroy()
        return found

    found, block = None, []
    for row in asked.toLocalIterator():
        if len(block) == query_block:
            part = written(block)
            found, block = part if found is None else found.unionAll(part), []
        block.append(row)
    if found is None:
        return run(block)[0]
    # The distinct vectors of one query may lie in several blocks.
    return first(found.unionAll(written(block)).drop("rank"))


def op8_kdtree_topk(spark, sf_dir):
    return top_k(common.table(spark, sf_dir, "embeddings"), lambda c: c % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""
