"""Repeated word passages, located by sharded Aho-Corasick automata.

A word goes when a run of ``WINDOW`` words covering it also starts elsewhere.

1. A window's anchor is the run of ``GRAM`` words with the least hash in it
   (the leftmost of equal ones): equal windows have equal anchors.  Consecutive
   windows share an anchor, so a text is cut into segments, runs of windows
   with one anchor occurrence.  Segments are counted by anchor and content; an
   anchor met once holds nothing that recurs and is left.
2. The distinct segments of the other anchors, with their words, are dealt to
   tasks by anchor, so equal windows meet.  There passages are confirmed: the
   windows of an anchor's segments are compared word by word and counted, and
   every run of windows that occur twice is a passage.
3. The passages of as many anchors as make up ``SHARD_WORDS`` words are
   compiled into one automaton over word numbers, and the shard's segments
   stream through it: what it reports are all occurrences.
4. Occurrences go from distinct segments to every document that holds them.

Hot anchors: an anchor with more than ``crowd`` distinct segments is not given
to one task; the windows of its segments are cut again by longer grams (20
words, then the window itself, whose segments are all equal), which changes
how windows are dealt, never which are found.  Copies of a segment are one row
after a combining sum, and one of them sends its words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

WINDOW = 35
GRAMS = (8, 20, WINDOW)     # words of an anchor; the next is for windows of hot anchors
CROWD = 20_000              # distinct segments of an anchor that one task takes
SHARD_WORDS = 400_000       # words of the passages in one automaton
_CACHE = 1 << 20            # word hashes a task remembers
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than blanks (``bytes.split`` parts at \\x20 and \\x09-\\x0D)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _C1) ^ ((b << np.uint64(23)) | (b >> np.uint64(41)))
    h = (h ^ (h >> np.uint64(29))) * _C2
    return h ^ (h >> np.uint64(32))


def run_hashes(w: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words at each position."""
    out, at, step, part = None, 0, 1, w
    while True:
        if length & step:
            if out is None:
                out = part
            else:
                n = len(part) - at
                out = _join(out[:n], part[at:])
            at += step
        if step * 2 > length:
            return out
        part = _join(part[:len(part) - step], part[step:])
        step *= 2


def segments(w: np.ndarray, window: int, gram: int):
    """``anchor hash, content hash, first window, windows`` of the segments of
    a text's word hashes."""
    n = len(w) - window + 1
    g = run_hashes(w, gram)
    span = window - gram + 1
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1)
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[start, n])
    # A segment is at most twice a window long: its two ends cover it.
    ends = run_hashes(w, window)
    content = _join(_join(ends[start], ends[start + count - 1]), count.astype(np.uint64))
    return g[at[start]].view(np.int64), content.view(np.int64), start, count


_SEGMENT = "_k1 long, _k2 long, m long, sh long, start int, n int"


def _cut(batches, window: int, gram: int):
    """Segments of whole texts, or of the runs of windows in ``runs``."""
    known = _Hashes()
    for pdf in batches:
        keys, parts = [], []
        runs = pdf["runs"] if "runs" in pdf.columns else [None] * len(pdf)
        for k1, k2, t, only in zip(pdf["_k1"], pdf["_k2"], pdf["t"], runs):
            ws = words(t)
            if len(ws) < window:
                continue
            w = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
            whole = [(0, len(ws) - window + 1)]
            for a, k in whole if only is None else [(x["start"], x["n"]) for x in only]:
                m, sh, start, n = segments(w[a:a + k + window - 1], window, gram)
                keys.append((k1, k2, len(m)))
                parts.append((m, sh, start + a, n))
        if keys:
            ones, twos, times = (np.array(x, np.int64) for x in zip(*keys))
            m, sh, start, n = (np.concatenate(x) for x in zip(*parts))
            yield pd.DataFrame({"_k1": np.repeat(ones, times), "_k2": np.repeat(twos, times), "m": m, "sh": sh,
                                "start": start.astype(np.int32), "n": n.astype(np.int32)})


_UNIT = "m long, sh long, many boolean, n int, words binary"


def _units(batches, window: int):
    """The words of marked segments."""
    for pdf in batches:
        out = []
        for t, marks in zip(pdf["t"], pdf["marks"]):
            ws = words(t)
            out += [(x["m"], x["sh"], x["many"], x["n"], b" ".join(ws[x["start"]:x["start"] + x["n"] + window - 1]))
                    for x in marks]
        if out:
            yield pd.DataFrame(out, columns=["m", "sh", "many", "n", "words"])


class Shard:
    """Passages of some anchors and the segments to look for them in.  Words
    are numbered as they come; a number is a character, so a run of words is a
    string."""

    def __init__(self, window: int):
        self.window = window
        self.numbers: dict[bytes, str] = {}
        self.passages: set[str] = set()
        self.size = 0
        self.rows: list[tuple[int, int, str]] = []

    def line(self, text: bytes) -> str:
        numbers = self.numbers
        out = []
        for w in text.split():
            c = numbers.get(w)
            if c is None:
                k = len(numbers) + 1
                c = numbers[w] = chr(k if k < 0xD800 else k + 0x800)
            out.append(c)
        return "".join(out)

    def add(self, group: list[tuple[int, int, bool, int, bytes]]) -> None:
        """One anchor's distinct segments: ``m, sh, many, n, words``."""
        window = self.window
        lines = [(m, sh, many, self.line(text)) for m, sh, many, _, text in group]
        counts: dict[str, int] = {}
        if len(lines) > 1:
            for _, _, many, s in lines:
                for i in range(len(s) - window + 1):
                    counts[s[i:i + window]] = counts.get(s[i:i + window], 0) + (2 if many else 1)
        for m, sh, many, s in lines:
            self.rows.append((m, sh, s))
            self.size += len(s)
            if many:
                self.passages.add(s)
                continue
            first = None
            for i in range(len(s) - window + 2):
                twice = i <= len(s) - window and counts.get(s[i:i + window], 0) > 1
                if twice and first is None:
                    first = i
                elif not twice and first is not None:
                    self.passages.add(s[first:i + window - 1])
                    first = None

    def occurrences(self):
        """``m, sh, a, b``: words ``a .. b`` of a segment that passages cover."""
        if not self.passages:
            return
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in self.passages:
            automaton.add_word(p, len(p))
        automaton.make_automaton()
        for m, sh, s in self.rows:
            spans: list[list[int]] = []
            for end, length in automaton.iter(s):
                a = end - length + 1
                while spans and a <= spans[-1][0]:
                    spans.pop()
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = end + 1
                else:
                    spans.append([a, end + 1])
            for a, b in spans:
                yield m, sh, a, b


_HIT = "m long, sh long, a int, b int"


def _locate(batches, window: int, shard_words: int):
    """Rows sorted by anchor: shards of as many anchors as fit, one at a time."""
    shard, key, group, last = Shard(window), None, [], None

    def found():
        return pd.DataFrame(list(shard.occurrences()), columns=["m", "sh", "a", "b"])

    for pdf in batches:
        for row in pdf[["m", "sh", "many", "n", "words"]].itertuples(index=False, name=None):
            if row[0] != key:
                if group:
                    shard.add(group)
                if shard.size >= shard_words:
                    yield found()
                    shard = Shard(window)
                key, group, last = row[0], [], None
            if row[1] != last:  # a segment that its text or a repeated row holds twice
                group.append(row)
                last = row[1]
    if group:
        shard.add(group)
    yield found()


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                crowd: int = CROWD, shard_words: int = SHARD_WORDS, grams=GRAMS) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``docs`` packed by row key, ``marks`` null where nothing can
    recur) and ``_k1, _k2, a, b``: word ranges that recurring windows cover."""
    if not 0 < grams[0] <= window or grams[-1] != window:
        raise ValueError(f"anchors must be of up to {window} words and end with {window}, got {grams}")
    spark = docs.sparkSession
    common.prepare(spark)
    packed = common.packed(docs, id_col, text_col)
    texts = packed.select("_k1", "_k2", F.col("_row").getField(text_col).alias("t"))
    rows, hits = None, []
    for gram in grams:
        segs = texts.mapInPandas(lambda it, gram=gram: _cut(it, window, gram), _SEGMENT)
        every = common.saved(segs, "phrase-segments")
        met = every.groupBy("m").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1).select("m")
        # Read from a table, the anchors let a skewed join be split.
        met = common.saved(met, "phrase-met")
        segs = common.saved(every.join(met, "m", "left_semi"), "phrase-open")
        common.discard(every)
        common.discard(met)
        kinds = segs.groupBy("m", "sh").agg((F.count(F.lit(1)) > 1).alias("many"), F.min("_k1").alias("first"))
        anchors = kinds.groupBy("m").agg(F.count(F.lit(1)).alias("k"))
        hot = (F.col("k") > crowd) if gram < window else F.lit(False)
        kinds = common.saved(kinds.join(anchors, "m").select("m", "sh", "many", "first", hot.alias("hot")), "phrase-kinds")
        # One document a segment sends its words; of hot anchors all are cut again.
        sends = F.col("hot") | (F.col("_k1") == F.col("first"))
        marks = segs.join(kinds, ["m", "sh"]).groupBy("_k1", "_k2").agg(
            F.collect_set(F.when(sends, F.struct("start", "n", "m", "sh", "many", "hot"))).alias("marks"))
        if rows is None:
            rows = common.saved(packed.join(marks.hint("shuffle_hash"), ["_k1", "_k2"], "left"), "phrase-rows")
            marked = rows.filter(F.col("marks").isNotNull()).select(
                "_k1", "_k2", F.col("_row").getField(text_col).alias("t"), "marks")
        else:
            marked = common.saved(texts.drop("runs").join(marks, ["_k1", "_k2"]), "phrase-rows")
        calm = F.filter("marks", lambda x: ~x["hot"])
        units = marked.filter(F.size(calm) > 0).select("t", calm.alias("marks")).mapInPandas(
            lambda it: _units(it, window), _UNIT)
        located = units.repartition("m").sortWithinPartitions("m", "sh").mapInPandas(
            lambda it: _locate(it, window, shard_words), _HIT)
        located = common.saved(located, "phrase-hits")
        hits.append(segs.join(located, ["m", "sh"]).select(
            "_k1", "_k2", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b")))
        any_hot = kinds.filter("hot").limit(1).count() > 0
        common.discard(kinds)
        if not any_hot:
            break
        crowded = F.transform(F.filter("marks", lambda x: x["hot"]), lambda x: F.struct(x["start"], x["n"]))
        texts = marked.select("_k1", "_k2", "t", crowded.alias("runs")).filter(F.size("runs") > 0)
    out = hits[0]
    for more in hits[1:]:
        out = out.unionByName(more)
    return rows, out


def keep(ws: list, spans) -> list:
    """Words outside all spans."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            out += ws[at:a]
        at = max(at, b)
    return out + ws[at:]


_KEPT = "n_words long, n_removed long, kept binary"


def kept_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``_row`` (the row of ``docs``) and a struct ``_r`` of ``n_words,
    n_removed, kept`` (the kept words, joined by one space).

    Null, empty and blank texts have no words; texts under ``window`` words
    hold nothing recurring; repeated rows repeat each other; passages never
    cross documents; an empty table gives no rows.  Columns of ``docs`` may
    have any names.
    """
    rows, hits = occurrences(docs, id_col, text_col, **options)
    spans = hits.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("a", "b")).alias("_spans"))

    @F.pandas_udf(_KEPT)
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(text, spans):
            ws = words(t)
            left = keep(ws, [(x["a"], x["b"]) for x in s]) if s is not None and len(s) else ws
            out.append((len(ws), len(ws) - len(left), b" ".join(left)))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    marked, plain = rows.filter(F.col("marks").isNotNull()), rows.filter(F.col("marks").isNull())
    held = marked.drop("marks").join(spans.hint("shuffle_hash"), ["_k1", "_k2"], "left").select("_row", "_spans")
    rest = plain.select("_row", F.lit(None).cast(held.schema["_spans"].dataType).alias("_spans"))
    return held.unionByName(rest).select("_row", cut(F.col("_row").getField(text_col), F.col("_spans")).alias("_r"))


def remove_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the words of recurring passages; texts that lose none
    stay as they are, the others are their kept words joined by one space."""
    out = kept_words(docs, id_col, text_col, **options)
    text = F.when(F.col("_r.n_removed") > 0, F.col("_r.kept").cast("string")).otherwise(
        F.col("_row").getField(text_col))
    return common.unpacked(out, docs, **{text_col: text})


def op12_phrase_dedup(spark, sf_dir):
    out = kept_words(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", "_r.n_words", "_r.n_removed", F.sha2(F.col("_r.kept"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS k FROM d, unnest(range(1, len(w) - 33)) AS t(i)
), twice AS (
  SELECT rid, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)
), gone AS (
  SELECT rid, list(DISTINCT i + j) AS p FROM twice, unnest(range(0, 35)) AS t(j) GROUP BY rid
), kept AS (
  SELECT d.rid, string_agg(x, ' ' ORDER BY d.n) AS s, count(*) AS c
  FROM (SELECT d.rid, unnest(w) AS x, generate_subscripts(w, 1) AS n FROM d) d
  LEFT JOIN (SELECT rid, unnest(p) AS n, true AS g FROM gone) o ON o.rid = d.rid AND o.n = d.n
  WHERE g IS NULL GROUP BY d.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(c, 0))::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
