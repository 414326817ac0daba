"""Benchmark decontamination with one Aho-Corasick automaton.

Method: benchmark texts are normalised to words; every run of 13 consecutive
words of an item (or the whole item, if shorter) is a pattern.  One automaton
over all patterns scans each document's word sequence once; a hit's words map
back to character offsets of the original text.

Words become numbers through the benchmark's own vocabulary, so the automaton
reads one symbol per word and words the benchmark lacks never match.  The
automaton is broadcast.  A benchmark beyond ``BLOCK_WORDS`` words is cut into
blocks of items: the driver holds one block at a time and broadcasts it alone,
all documents pass it, its hits are written by row key, and the block is
released before the next.  The hits of all blocks are merged by row, so
memory is bounded whatever the benchmark's size, and the result is the same.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

WINDOW = 13
BLOCK_WORDS = 500_000  # words per automaton: about 6.5 million nodes at most
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    """Lower-case A-Z only; offsets stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text)) if text else []


class Matcher:
    """Windows of some items and the automaton over them."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary: dict[str, int] = {}
        self.patterns: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for a in range(max(1, len(ids) - window + 1) if ids else 0):
                self.patterns.setdefault(tuple(ids[a:a + window]), set()).add(item)
        self._automaton = None

    def __getstate__(self):
        return self.vocabulary, self.patterns

    def __setstate__(self, state):
        self.vocabulary, self.patterns = state
        self._automaton = None

    def automaton(self):
        """Built once per Python worker."""
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for p, items in self.patterns.items():
                a.add_word(p, (len(p), sorted(items)))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def scan(self, text: str | None):
        """``(n_words, hit, items)``: ``hit`` is a sorted array of word
        numbers inside an occurrence, ``items`` the item ids that occur."""
        found = words(text)
        if not found or not self.patterns:
            return len(found), np.empty(0, np.int64), set()
        get = self.vocabulary.get
        ids = tuple([get(w, 0) for w in found])
        starts, ends, items = [], [], set()
        for end, (n, names) in self.automaton().iter(ids):
            starts.append(end - n + 1)
            ends.append(end + 1)
            items.update(names)
        if not starts:
            return len(found), np.empty(0, np.int64), items
        depth = np.zeros(len(found) + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, ends, -1)
        return len(found), np.flatnonzero(np.cumsum(depth[:-1]) > 0), items

    def spans(self, text: str | None) -> list[tuple[int, int]]:
        """Character ranges of the original text that hits cover."""
        _, hit, _ = self.scan(text)
        at = [m.span() for m in WORD.finditer(lower(text))] if len(hit) else []
        out: list[tuple[int, int]] = []
        last = None
        for w in hit.tolist():
            if last is not None and w == last + 1:
                out[-1] = (out[-1][0], at[w][1])
            else:
                out.append(at[w])
            last = w
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Matchers over the benchmark, block by block in item order."""
    rows, n = [], 0
    items = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).distinct()
    for item, text in items.sort(*items.columns).toLocalIterator():
        rows.append((item, text))
        n += len(words(text))
        if n >= block_words:
            yield Matcher(rows)
            rows, n = [], 0
    if rows:
        yield Matcher(rows)


_SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _scanner(held):
    """``n_words, n_hit, n_items, items_sha256, contaminated`` by one automaton
    (None: an empty benchmark)."""
    @F.pandas_udf(_SCHEMA)
    def judged(text: pd.Series) -> pd.DataFrame:
        out = []
        for t in text:
            n, hit, items = held.value.scan(t) if held else (len(words(t)), (), ())
            out.append((n, len(hit), len(items), _digest(items), len(hit) > 0 and 20 * len(hit) >= n))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return judged


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """Sorted word numbers as ranges ``a .. b``."""
    cut = np.flatnonzero(np.diff(hit) > 1) + 1
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(hit, cut)] if len(hit) else []


def _block_hits(texts: DataFrame, matcher: Matcher) -> DataFrame:
    """``_k1, _k2, runs, items`` of the rows that a block hits, written."""
    held = texts.sparkSession.sparkContext.broadcast(matcher)

    def scan(batches):
        for pdf in batches:
            out = []
            for k1, k2, t in zip(pdf["_k1"], pdf["_k2"], pdf["t"]):
                _, hit, items = held.value.scan(t)
                if len(hit):
                    out.append((k1, k2, [{"a": a, "b": b} for a, b in _runs(hit)], sorted(items)))
            if out:
                yield pd.DataFrame(out, columns=["_k1", "_k2", "runs", "items"])

    found = common.saved(texts.mapInPandas(
        scan, "_k1 long, _k2 long, runs array<struct<a:int,b:int>>, items array<string>"), "decontam-hits")
    held.destroy()
    return found


def _merged(text: pd.Series, runs: pd.Series, items: pd.Series) -> pd.DataFrame:
    out = []
    for t, rs, its in zip(text, runs, items):
        n = len(words(t))
        hit = np.zeros(n, bool)
        for r in () if rs is None else rs:
            hit[r["a"]:r["b"]] = True
        k, names = int(hit.sum()), set(() if its is None else its)
        out.append((n, k, len(names), _digest(names), k > 0 and 20 * k >= n))
    return pd.DataFrame(out, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def judge(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``_row`` (the row of ``docs``) and a struct ``_c`` of ``n_words, n_hit,
    n_items, items_sha256, contaminated`` (``n_hit > 0`` and
    ``20 n_hit >= n_words``).

    Null or empty texts have no words and are clean; items without words have
    no pattern; repeated items are one; an empty benchmark hits nothing.
    Repeated rows are judged each.  Columns of ``docs`` may have any names.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    every = blocks(benchmark, item_id, item_text, block_words)
    first, second = next(every, None), next(every, None)
    if second is None:
        held = spark.sparkContext.broadcast(first) if first else None
        rows = docs.select(F.struct(*[common.quoted(c) for c in docs.columns]).alias("_row"))
        return rows.withColumn("_c", _scanner(held)(F.col("_row").getField(text_col)))
    k1, k2 = common.row_key(text_col)
    rows = docs.select(F.struct(*[common.quoted(c) for c in docs.columns]).alias("_row"), k1.alias("_k1"), k2.alias("_k2"))
    texts = rows.select("_k1", "_k2", F.col("_row").getField(text_col).alias("t"))
    found = None
    for matcher in chain((first, second), every):
        hits = _block_hits(texts, matcher)
        found = hits if found is None else found.unionByName(hits)
    # Rows of one text have one key, and the same hits.
    found = found.groupBy("_k1", "_k2").agg(F.flatten(F.collect_set("runs")).alias("runs"),
                                            F.flatten(F.collect_set("items")).alias("items"))
    met = rows.join(found.hint("shuffle_hash"), ["_k1", "_k2"], "left")
    merged = F.pandas_udf(_merged, _SCHEMA)
    return met.select("_row", merged(F.col("_row").getField(text_col), F.col("runs"), F.col("items")).alias("_c"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows."""
    return common.unpacked(judge(docs, benchmark, text_col).filter(~F.col("_c.contaminated")), docs)


def op6_decontaminate(spark, sf_dir):
    out = judge(common.table(spark, sf_dir, "documents").select("doc_id", "text"),
                common.table(spark, sf_dir, "benchmark"))
    return out.select("_row.doc_id", "_c.*")


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(list_slice(w, i, i + 12), ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), occ AS (
  SELECT d.rid, s.n, t.i, array_to_string(list_slice(d.w, t.i, t.i + s.n - 1), ' ') AS k
  FROM (SELECT DISTINCT n FROM win) s, d, unnest(range(1, len(d.w) - s.n + 2)) AS t(i)
), hits AS (
  SELECT occ.rid, occ.i, occ.n, win.item_id FROM occ JOIN win ON win.n = occ.n AND win.k = occ.k
), pos AS (
  SELECT rid, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, n)) AS t(j) GROUP BY rid
), its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
