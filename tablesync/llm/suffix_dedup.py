"""Repeated byte strings, found by sorting suffixes deep and shallow.

A byte goes when a ``LENGTH``-byte string covering it also starts elsewhere.
Sorting every suffix of a corpus means shuffling it hundreds of times over, so
windows of ``LENGTH`` bytes are first routed by content:

1. A window's anchor is the gram of ``GRAM`` bytes with the least hash in it
   (the leftmost of equal ones).  Equal windows have equal anchors at the same
   offset, and consecutive windows share an anchor, so a text is cut into
   segments: runs of windows with one anchor occurrence.  Segments are counted
   by content.  A segment met twice is repeated throughout; an anchor with one
   segment holds nothing repeated.
2. What remains are anchors with different segments, some met once: there a
   repeat may begin or end.  Windows of a segment are cut into chunks by their
   offset to the anchor.  All windows of a chunk hold the chunk's core, so only
   suffixes with an equal core can agree for ``LENGTH`` bytes; the core decides
   the task that sorts them.
3. There, the suffixes that start at one offset are sorted: multikey quicksort
   over the bytes before the core (the shallow depth), then, for those that
   still tie and so share a prefix longer than the core, a blind trie over the
   bytes after it.  Neighbours that agree throughout are repeats.

Equal segments are one row after a combining sum, so a group of copies costs a
row.  A core shared by more than ``HOT`` segments is not sorted in one task:
its suffixes are dealt out one by one by a hash and counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

LENGTH = 400
GRAM = 32
CHUNK = 32              # windows per chunk: one bit each in an int
HOT = 1000
BLOCK = 1 << 22         # window starts handled at once in a long text
FILTER_BITS = 1 << 25   # 4 MB: marks anchors of step 2 for the tasks that cut texts
SEEN = 200_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at each position."""
    w = b.astype(np.uint64)
    w = w[:-1] | w[1:] << np.uint64(8)
    w = w[:-2] | w[2:] << np.uint64(16)
    w = w[:-4] | w[4:] << np.uint64(32)
    n = len(b) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for i in range(GRAM // 8):
        h ^= w[8 * i:8 * i + n]
        h *= _MIX[i % 4]
        h ^= h >> np.uint64(31)
    return h


def segments(data: bytes, length: int = LENGTH):
    """``(anchor hash, start, windows, offset)`` arrays: runs of windows that
    share an anchor, ``offset`` being the anchor's distance from ``start``."""
    out = []
    grams = length - GRAM + 1  # grams in a window
    for x in range(0, max(len(data) - length + 1, 0), BLOCK):
        part = np.frombuffer(data, np.uint8)[x:x + BLOCK + length - 1]
        h = gram_hashes(part)
        place = np.uint64((1 << 24) - 1)
        c = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        s = 1
        while 2 * s <= grams:
            c = np.minimum(c[:-s], c[s:])
            s *= 2
        if s < grams:
            c = np.minimum(c[:len(c) - (grams - s)], c[grams - s:])
        at = (c & place).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], cut])
        n = np.diff(np.concatenate([first, [len(at)]]))
        out.append((h[at[first]].view(np.int64), first + x, n, at[first] - first))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(p) for p in zip(*out))


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _cut(batches, length):
    """Segment rows ``_k1, _k2, m, sh, start, span`` of whole texts."""
    for pdf in batches:
        out = {c: [] for c in ("_k1", "_k2", "m", "sh", "start", "span")}
        for k1, k2, t in zip(pdf["_k1"], pdf["_k2"], pdf["t"]):
            data = t.encode("utf-8", "surrogatepass") if t else b""
            m, start, n, offset = segments(data, length)
            if not len(m):
                continue
            out["_k1"].append(np.full(len(m), k1))
            out["_k2"].append(np.full(len(m), k2))
            out["m"].append(m)
            out["start"].append(start)
            out["span"].append(n + 1024 * offset)
            out["sh"].append(np.array([_hash(data[a:b]) for a, b in
                                       zip(start.tolist(), (start + n + length - 1).tolist())]))
        if out["m"]:
            yield pd.DataFrame({c: np.concatenate(v) for c, v in out.items()})


def pieces(data: bytes, start: int, n: int, offset: int, anchor_hash: int, length: int = LENGTH):
    """``(core hash, first, last, chunk, left, right)`` per chunk of a segment:
    windows whose anchor is ``first .. last`` bytes in, and the bytes that they
    have before and after the core."""
    anchor = start + offset
    head = anchor_hash.to_bytes(8, "little", signed=True)
    for c in range((offset - n + 1) // CHUNK, offset // CHUNK + 1):
        lo, hi = max(c * CHUNK, offset - n + 1), min(c * CHUNK + CHUNK - 1, offset)
        a, b = anchor - c * CHUNK, anchor - c * CHUNK - CHUNK + 1 + length
        core = _hash(head + bytes([c & 255, c >> 8]) + data[a:b])
        yield core, lo, hi, c, data[anchor - hi:a], data[b:anchor - lo + length]


class BlindTrie:
    """A trie of branching positions only.  A string goes down by the bytes at
    those positions, is compared once with the leaf it meets, and branches off
    where the two differ."""

    def __init__(self):
        self.root = None  # leaf: (string, ids); node: [position, {byte: child}]

    def add(self, s: bytes, ident) -> None:
        if self.root is None:
            self.root = (s, [ident])
            return
        node, path = self.root, []
        while isinstance(node, list):
            path.append(node)
            below = node[1]
            node = below.get(s[node[0]])
            if node is None:
                node = next(iter(below.values()))
                while isinstance(node, list):
                    path.append(node)
                    node = next(iter(node[1].values()))
                break
        known = node[0]
        if known == s:
            node[1].append(ident)
            return
        at = next(i for i, (x, y) in enumerate(zip(known, s)) if x != y)
        above, here = None, self.root
        for p in path:
            if p[0] >= at:
                here = p
                break
            above, here = p, p[1][s[p[0]]]
        if isinstance(here, list) and here[0] == at:
            here[1][s[at]] = (s, [ident])
            return
        branch = [at, {known[at]: here, s[at]: (s, [ident])}]
        if above is None:
            self.root = branch
        else:
            above[1][s[above[0]]] = branch

    def runs(self):
        """``(string, ids)`` in order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack.extend(v for _, v in sorted(node[1].items(), reverse=True))
            else:
                yield node


def sorted_runs(items: list[tuple[bytes, bytes, object]]):
    """Deep-shallow sort of ``(before, after, id)`` suffixes with one core
    between; yields ``(before, after, ids)`` in order, equal ones together."""
    stack = [(items, 0)]
    while stack:
        part, depth = stack.pop()
        if not part:
            continue
        if len(part) == 1:
            yield part[0][0], part[0][1], [part[0][2]]
            continue
        if depth == len(part[0][0]):  # equal up to the end of the core: deep
            trie = BlindTrie()
            for _, after, ident in part:
                trie.add(after, ident)
            for after, ids in trie.runs():
                yield part[0][0], after, ids
            continue
        pivot = part[len(part) // 2][0][depth]
        stack.append(([x for x in part if x[0][depth] > pivot], depth))
        stack.append(([x for x in part if x[0][depth] == pivot], depth + 1))
        stack.append(([x for x in part if x[0][depth] < pivot], depth))


def repeated_windows(group):
    """``group``: ``(sh, first, last, chunk, left, right)`` rows with one core.
    Yields ``(sh, chunk, mask)``: the windows of a piece, by offset within the
    chunk, that another segment has too."""
    rows = {(g[0], g[1], g[2]): g for g in group}  # the same segment from several tasks
    if len({r[0] for r in rows.values()}) < 2:
        return
    masks: dict[tuple[int, int], int] = {}
    by_offset: dict[int, list] = {}
    for sh, lo, hi, c, left, right in rows.values():
        for w in range(lo, hi + 1):
            by_offset.setdefault(w, []).append((left[hi - w:], right[:c * CHUNK + CHUNK - 1 - w], (sh, c)))
    for w, items in by_offset.items():
        if len(items) < 2:
            continue
        for _, _, ids in sorted_runs(items):
            if len(ids) > 1 and len(set(ids)) > 1:
                for sh, c in ids:
                    masks[sh, c] = masks.get((sh, c), 0) | 1 << (w - c * CHUNK)
    for (sh, c), mask in masks.items():
        yield sh, c, mask


_PIECE = "m long, sh long, core long, lo int, hi int, chunk int, l binary, r binary"
_PIECE_COLUMNS = ["m", "sh", "core", "lo", "hi", "chunk", "l", "r"]
_MASK = "m long, sh long, chunk int, mask long"


def _pieces_of(texts, wanted, length):
    """Piece rows of the segments that ``wanted(anchor hashes, starts, row)``
    picks, each segment content once for every ``SEEN`` of a task."""
    seen: set = set()
    for pdf in texts:
        out = []
        for row in pdf.itertuples(index=False):
            data = row.t.encode("utf-8", "surrogatepass") if row.t else b""
            m, start, n, offset = segments(data, length)
            for i in np.flatnonzero(wanted(m, start, row)).tolist():
                s, k, h = int(start[i]), int(n[i]), int(m[i])
                sh = _hash(data[s:s + k + length - 1])
                if (h, sh) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add((h, sh))
                    out.extend((h, sh, *p) for p in pieces(data, s, k, int(offset[i]), h, length))
        if out:
            yield pd.DataFrame(out, columns=_PIECE_COLUMNS)


def _sort_task(batches):
    """Groups of rows sorted by core, one after the other."""
    key, group = None, []

    def done():
        return [(key[0], *x) for x in repeated_windows(group)] if len(group) > 1 else []

    for pdf in batches:
        out = []
        for m, sh, core, lo, hi, chunk, left, right in pdf[_PIECE_COLUMNS].itertuples(index=False, name=None):
            if key != (m, core):
                out += done()
                key, group = (m, core), []
            group.append((sh, lo, hi, chunk, left, right))
        if out:
            yield pd.DataFrame(out, columns=["m", "sh", "chunk", "mask"])
    if out := done():
        yield pd.DataFrame(out, columns=["m", "sh", "chunk", "mask"])


def _window_task(batches):
    """One row per window of a piece, with a hash of what is not the core."""
    for pdf in batches:
        out = []
        for m, sh, core, lo, hi, c, left, right in pdf[_PIECE_COLUMNS].itertuples(index=False, name=None):
            for w in range(lo, hi + 1):
                out.append((m, sh, core, c, w - c * CHUNK,
                            _hash(left[hi - w:] + b"|" + right[:c * CHUNK + CHUNK - 1 - w])))
        yield pd.DataFrame(out, columns=["m", "sh", "core", "chunk", "w", "sides"])


def _repeated_pieces(pieces_: DataFrame, hot: int) -> DataFrame:
    """``m, sh, chunk, mask`` of pieces with repeated windows."""
    crowded = common.saved(pieces_.groupBy("m", "core").agg(F.count(F.lit(1)).alias("k"))
                           .filter(F.col("k") > hot).select("m", "core"), "suffix-crowded")
    some = crowded.limit(1).count() > 0
    calm = pieces_.join(crowded, ["m", "core"], "left_anti") if some else pieces_
    masks = calm.repartition("m", "core").sortWithinPartitions("m", "core").mapInPandas(_sort_task, _MASK)
    if some:
        windows = pieces_.join(crowded, ["m", "core"], "left_semi").mapInPandas(
            _window_task, "m long, sh long, core long, chunk int, w int, sides long")
        windows = common.saved(windows, "suffix-windows")
        key = ["m", "core", "chunk", "w", "sides"]
        twice = windows.groupBy(*key).agg(F.min("sh").alias("x"), F.max("sh").alias("y")).filter(
            F.col("x") != F.col("y")).select(*key)
        twice = common.saved(twice, "suffix-twice")
        more = windows.join(twice, key, "left_semi").groupBy("m", "sh", "chunk").agg(
            F.bit_or(F.expr("shiftleft(1L, w)")).alias("mask"))
        masks = masks.unionByName(more)
    return masks


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
            hot: int = HOT, filter_anchors: int = FILTER_BITS // 16) -> DataFrame:
    """``_k1, _k2, start, span, chunk, mask`` rows of repeated windows by row
    key: a segment from byte ``start`` of ``span % 1024`` windows whose anchor
    is ``span / 1024`` bytes in; all of them (``chunk`` -1), or those of a
    chunk that ``mask`` names by their distance to the anchor."""
    if not GRAM <= length < 1024:
        raise ValueError(f"length must be {GRAM} to 1023, got {length}")
    spark = docs.sparkSession
    common.prepare(spark)
    k1, k2 = common.row_key(id_col, text_col)
    keyed = docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).alias("t"))
    segs = common.saved(keyed.mapInPandas(
        lambda it: _cut(it, length), "_k1 long, _k2 long, m long, sh long, start long, span int"), "suffix-segments")
    found = common.saved(segs.groupBy("m", "sh").agg(F.count(F.lit(1)).alias("c")), "suffix-classes")
    open_ = (found.groupBy("m").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least"))
             .filter((F.col("k") > 1) & (F.col("least") == 1)).select("m"))
    open_ = common.saved(open_, "suffix-open")

    if open_.count() <= filter_anchors:
        # A bitmap of fixed size marks the open anchors; one marked by chance
        # has nothing to match and costs only its rows.
        bit = F.col("m").bitwiseAND(F.lit(FILTER_BITS - 1))
        words = (open_.select(F.floor(bit / 64).cast("int").alias("w"),
                              F.expr("shiftleft(1L, cast(m & 63 as int))").alias("b"))
                 .groupBy("w").agg(F.bit_or("b")))
        bitmap = np.zeros(FILTER_BITS // 64, np.int64)
        for word, bits in words.toLocalIterator():
            bitmap[word] = bits
        held = spark.sparkContext.broadcast(bitmap)

        def wanted(m, start, row):
            bit = m & (FILTER_BITS - 1)
            return (held.value[bit >> 6] >> (bit & 63)) & 1

        texts = keyed.select("t")
    else:
        # Too many to mark: texts meet the starts of their open segments.
        def wanted(m, start, row):
            return np.isin(start, row.starts)

        marked = segs.join(open_.hint("shuffle_hash"), "m", "left_semi")
        starts = marked.groupBy("_k1", "_k2").agg(F.collect_set("start").alias("starts"))
        texts = keyed.join(starts.hint("shuffle_hash"), ["_k1", "_k2"]).select("t", "starts")
    parts = common.saved(texts.mapInPandas(lambda it: _pieces_of(it, wanted, length), _PIECE), "suffix-pieces")
    whole = found.filter(F.col("c") > 1).select("m", "sh", F.lit(-1).alias("chunk"), F.lit(0).cast("long").alias("mask"))
    flags = common.saved(_repeated_pieces(parts, hot).unionByName(whole), "suffix-flags")
    return segs.join(flags, ["m", "sh"]).select("_k1", "_k2", "start", "span", "chunk", "mask")


def covered(rows, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal byte ranges that the repeated windows of one text cover."""
    spans = []
    for start, span, chunk, mask in rows:
        if chunk < 0:
            spans.append((start, start + span % 1024 - 1 + length))
            continue
        anchor = start + span // 1024
        for w in range(CHUNK):
            if mask >> w & 1:
                at = anchor - chunk * CHUNK - w
                spans.append((at, at + length))
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_KEPT = "n_bytes long, n_removed long, n_spans long, kept binary"


def kept_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
               **options) -> DataFrame:
    """``_row`` (the row of ``docs``) and a struct ``_r`` of ``n_bytes,
    n_removed, n_spans, kept``.

    Null texts are empty, texts under ``length`` bytes hold nothing repeated.
    Repeated rows repeat each other.  Matches never cross documents.  Columns
    of ``docs`` may have any names.
    """
    hit = repeats(docs, id_col, text_col, length, **options).groupBy("_k1", "_k2").agg(
        F.collect_set(F.struct("start", "span", "chunk", "mask")).alias("_hits"))

    @F.pandas_udf(_KEPT)
    def cut(text: pd.Series, hits: pd.Series) -> pd.DataFrame:
        out = []
        for t, h in zip(text, hits):
            data = t.encode("utf-8", "surrogatepass") if t else b""
            rows = [] if h is None else [(x["start"], x["span"], x["chunk"], x["mask"]) for x in h]
            spans, parts, at = covered(rows, length), [], 0
            for a, b in spans:
                parts.append(data[at:a])
                at = b
            kept = b"".join(parts) + data[at:]
            out.append((len(data), len(data) - len(kept), len(spans), kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    joined = common.packed(docs, id_col, text_col).join(hit.hint("shuffle_hash"), ["_k1", "_k2"], "left")
    return joined.select("_row", cut(F.col("_row").getField(text_col), F.col("_hits")).alias("_r"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated bytes taken out of the text.  A character of which
    only some bytes stay goes too; null texts stay null."""
    out = kept_bytes(docs, id_col, text_col, length)

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return pd.Series([None if k is None else k.decode("utf-8", "ignore") for k in kept], dtype=object)

    text = F.when(F.col("_row").getField(text_col).isNotNull(), decoded(F.col("_r.kept")))
    return common.unpacked(out, docs, **{text_col: text})


def op5_suffix_dedup(spark, sf_dir):
    out = kept_bytes(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", "_r.n_bytes", "_r.n_removed", "_r.n_spans",
                      F.sha2(F.col("_r.kept"), 256).alias("kept_sha256"))
