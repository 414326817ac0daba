"""Near-duplicates: consistent weighted sampling over TF-IDF shingles.

Method: a text is a set of shingles of ``SHINGLE`` words, a shingle weighing
``(1 + ln tf) * (1 + IDF_SPAN * idf)`` with idf in 0..1: the logarithm of the
share of documents that hold it, to the base ``1 / RARE``, and 1 for shingles in
fewer than one of ``RARE`` documents.  Improved consistent weighted sampling draws ``BANDS * ROWS`` samples whose chance of agreeing is
the weighted Jaccard similarity of two texts.  Texts that agree on all samples
of a band are candidates; those are verified by their exact weighted Jaccard
similarity, and verified links join texts into classes.  A candidate is left
unverified only where a bound proves it too different: the common weight is at
most the smaller one in each of ``BINS`` parts of the shingle hashes.

Scale: exact copies are one node (by a hash of their words), so a group of
copies costs one row.  A bucket of a band sends its members to its two hubs (its most central node and the
least one) and not to each other; a second step compares what is left in
buckets whose members are still in different classes, where weights allow.
Document frequencies are exact.  A first pass sums all occurrences in a table of
``PLACES`` places; a shingle in one of ``RARE`` documents lies in a place that
reaches that many, so the second pass counts the documents of shingles in such
places only, by a grouped sum.  What is broadcast is that table's marks and the
frequent shingles, of which there are at most ``RARE`` times the mean number of
distinct shingles a document, whatever the corpus.  Texts of over some 4 000
shingles on average fill all places: counts stay exact, but every shingle is grouped.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 15, 4
SAMPLES = BANDS * ROWS
RARE = 256          # a shingle in fewer than one of so many documents has the full idf
PLACES = 1 << 20    # counters of the pass that looks for frequent shingles
PART = 1 << 12      # counters a row of that pass
IDF_LEVELS = 8      # idf in eighths: weights take few values
IDF_SPAN = 0.1
BINS = 64           # parts of a set that the bounds on common weight look at
DRAWS = 1 << 16     # places of the table of random draws
BLOCK = 4096
HELD = 1 << 20      # shingles a task holds before it counts them
RUN = 1 << 15       # words hashed at once, but for one longer text

_WORD = re.compile(r"\w+")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def shingles(found: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes and how often each occurs; fewer
    words than ``size`` are one shingle."""
    return np.unique(running(found, size), return_counts=True)


def running(found: list[str], size: int = SHINGLE) -> np.ndarray:
    """The hash of the shingle at every place of the text."""
    return _mixed(_hashed(found, len(found)), min(size, len(found)))


def _hashed(found, n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every ``k`` word hashes in a row."""
    n = len(h) - k + 1 if k else 0
    s = np.full(max(n, 0), np.uint64(k))
    for i in range(k if len(s) else 0):
        s = (s ^ h[i:i + n]) * _MULTIPLY
        s ^= s >> np.uint64(29)
    return s


def runs(texts):
    """Per text its words and its ``running`` hashes; short texts are hashed together."""
    held, n = [], 0
    for t in texts:
        held.append(words(t))
        n += len(held[-1])
        if n >= RUN:
            yield from zip(held, _running_together(held, n))
            held, n = [], 0
    yield from zip(held, _running_together(held, n))


def _running_together(lists: list[list[str]], n: int):
    h = _hashed(chain.from_iterable(lists), n)
    s, a = _mixed(h, SHINGLE), 0
    for found in lists:
        b = a + len(found)
        yield s[a:b - SHINGLE + 1] if b - a >= SHINGLE else _mixed(h[a:b], b - a)
        a = b


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)


class Sampler:
    """Draws for every (sample, shingle) and weights from document frequencies:
    the idf levels of the frequent shingles, every other one having the last."""

    def __init__(self, frequent: np.ndarray, levels: np.ndarray):
        order = np.argsort(frequent)
        self.frequent, self.levels = frequent[order], levels[order]
        self.marked = np.zeros(PLACES, bool)
        self.marked[_place(self.frequent)] = True
        rng = np.random.default_rng(20240601)
        self.r = rng.gamma(2.0, 1.0, DRAWS)
        self.log_c = np.log(rng.gamma(2.0, 1.0, DRAWS))
        self.beta = rng.random(DRAWS)
        self.odd = rng.integers(1, 1 << 62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # Texts repeat few shingles: the draw of a weight with tf 1 is a table.
        logs = np.log(1 + IDF_SPAN * np.arange(IDF_LEVELS) / (IDF_LEVELS - 1))
        self.once = np.stack([self._draw(x, slice(None))[0] for x in logs]).astype(np.float32).ravel()

    def _draw(self, log_weight, at):
        t = np.floor(log_weight / self.r[at] + self.beta[at])
        return self.log_c[at] - self.r[at] * (t - self.beta[at]) - self.r[at], t

    def weights(self, hashes: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        level = np.full(len(hashes), IDF_LEVELS - 1)
        at = np.flatnonzero(self.marked[_place(hashes)])
        if len(at):
            i = np.minimum(np.searchsorted(self.frequent, hashes[at]), len(self.frequent) - 1)
            level[at] = np.where(self.frequent[i] == hashes[at], self.levels[i], IDF_LEVELS - 1)
        return level, (1 + np.log(tf)) * (1 + IDF_SPAN * level / (IDF_LEVELS - 1))

    def signature(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """``SAMPLES`` 32-bit values; each is one consistent weighted sample:
        the drawn shingle and the step of its weight."""
        level, weight = self.weights(hashes, tf)
        best = np.full(SAMPLES, np.inf, np.float32)
        chosen = np.zeros(SAMPLES, np.int64)
        rows = np.arange(SAMPLES)
        for a in range(0, len(hashes), BLOCK):
            h = hashes[a:a + BLOCK]
            place = ((h * self.odd[:, None]) >> np.uint64(48)).astype(np.int32)
            value = self.once.take(place + (level[a:a + BLOCK].astype(np.int32) << 16))
            many = np.flatnonzero(tf[a:a + BLOCK] > 1)
            if len(many):
                value[:, many] = self._draw(np.log(weight[a + many]), place[:, many])[0]
            least = value.argmin(axis=1)  # ties: the smaller hash
            v = value[rows, least]
            better = v < best
            best = np.where(better, v, best)
            chosen = np.where(better, least + a, chosen)
        h = hashes[chosen]
        place = ((h * self.odd) >> np.uint64(48)).astype(np.int64)
        _, t = self._draw(np.log(weight[chosen]), place)
        mixed = (h ^ t.astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * _MULTIPLY
        return (mixed >> np.uint64(32)).astype(np.uint32)


def band_keys(signature: np.ndarray) -> list[int]:
    """One 64-bit bucket per band."""
    out = np.zeros(BANDS, np.uint64)
    s = signature.reshape(BANDS, ROWS).astype(np.uint64)
    for i in range(ROWS):
        out = (out ^ s[:, i]) * _MULTIPLY
        out ^= out >> np.uint64(31)
    return ((out ^ np.arange(BANDS, dtype=np.uint64)) * _MULTIPLY).astype(np.int64).tolist()


def fit_sampler(docs: DataFrame, text_col: str = "text") -> Sampler:
    """Idf levels from the exact number of documents of every frequent shingle."""
    texts = docs.select(F.col(text_col).alias("t"))

    def sieve(batches):
        held, parts, waiting, n = np.zeros(PLACES, np.int64), [], 0, 0
        for pdf in batches:
            for _, h in runs(pdf["t"]):
                if len(h):
                    n += 1
                    parts.append(h)
                    waiting += len(h)
                if waiting >= HELD:
                    held += np.bincount(_place(np.concatenate(parts)), minlength=PLACES)
                    parts, waiting = [], 0
        if parts:
            held += np.bincount(_place(np.concatenate(parts)), minlength=PLACES)
        if n:
            yield pd.DataFrame({"part": np.arange(-1, PLACES // PART), "n": [np.int64(n).tobytes()] + [
                x.tobytes() for x in held.reshape(-1, PART)]})

    def merged(batches):
        sums = {}
        for pdf in batches:
            for part, n in zip(pdf["part"], pdf["n"]):
                x = np.frombuffer(n, np.int64)
                sums[part] = sums[part] + x if part in sums else x
        if sums:
            yield pd.DataFrame({"part": list(sums), "n": [x.tobytes() for x in sums.values()]})

    # The parts of all tasks stream into the task of their number.
    summed = (texts.mapInPandas(sieve, "part int, n binary").repartition("part")
              .mapInPandas(merged, "part int, n binary"))
    total, load = 0, np.zeros(PLACES, np.int64)
    for part, n in summed.collect():  # 8 MB, whatever the corpus
        x = np.frombuffer(n, np.int64)
        if part < 0:
            total = int(x[0])
        else:
            load[part * PART:(part + 1) * PART] = x
    marked = load * RARE >= max(total, 1)
    none = Sampler(np.empty(0, np.uint64), np.empty(0, np.int64))
    if not marked.any():
        return none
    held_marks = docs.sparkSession.sparkContext.broadcast(marked)

    def count(batches):
        marks, parts, waiting = held_marks.value, [], 0

        def out():
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "n": n})

        for pdf in batches:
            for _, h in runs(pdf["t"]):
                h = np.unique(h[marks[_place(h)]])
                parts.append(h)
                waiting += len(h)
                if waiting >= HELD:
                    yield out()
                    parts, waiting = [], 0
        if parts:
            yield out()

    counts = texts.mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    frequent = counts.filter(F.col("n") * RARE >= total).toPandas()  # RARE x the mean size of a set at most
    share = frequent["n"].to_numpy(np.float64) / total
    idf = np.clip(-np.log(share) / np.log(RARE), 0.0, 1.0)
    return Sampler(frequent["h"].to_numpy(np.int64).view(np.uint64),
                   np.round(idf * (IDF_LEVELS - 1)).astype(np.int64))


def weighted_jaccard(a: bytes, b: bytes) -> float:
    """Exact similarity of two packed sets (see ``_packed``)."""
    ha, wa = _unpacked(a)
    hb, wb = _unpacked(b)
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    low = np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64)
    return float(low / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - low))


def _packed(hashes: np.ndarray, weight: np.ndarray) -> bytes:
    return hashes.tobytes() + weight.astype(np.float32).tobytes()


def _unpacked(x: bytes):
    n = len(x) // 12
    return np.frombuffer(x, np.uint64, n), np.frombuffer(x, np.float32, n, 8 * n)


def binned(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weight of a set in each of ``BINS`` parts of the hashes."""
    return np.bincount((hashes & np.uint64(BINS - 1)).astype(np.int64), weight, BINS).astype(np.float32)


def within_reach(p: np.ndarray, q: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of these binned weights (a row each) may reach the
    threshold: true wherever they do."""
    low = np.minimum(p, q).sum(axis=1, dtype=np.float64)
    return low * (1 + 1 / threshold) * (1 + 1e-5) >= p.sum(axis=1, dtype=np.float64) + q.sum(axis=1, dtype=np.float64)


def _agreeing(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity reaches the threshold."""
    @F.pandas_udf("boolean")
    def likely(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        return pd.Series(within_reach(*(np.frombuffer(b"".join(z), np.float32).reshape(-1, BINS) for z in (x, y)),
                                      threshold))

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(p, q) >= threshold for p, q in zip(x, y)], dtype=bool)

    bins = nodes.select("f", "bins")
    drawn = (pairs.join(bins.withColumnsRenamed({"f": "a", "bins": "_x"}), "a")
             .join(bins.withColumnsRenamed({"f": "b", "bins": "_y"}), "b")
             .filter(likely("_x", "_y")).select("a", "b"))
    drawn = common.saved(drawn, "near-drawn")
    return (drawn.join(sets.withColumnsRenamed({"f": "a", "set": "_x"}), "a")
            .join(sets.withColumnsRenamed({"f": "b", "set": "_y"}), "b")
            .filter(alike("_x", "_y")).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """``f, c``: the least node of each node's component, for nodes with an
    edge.  Least labels pass along edges and jump to the label of the label;
    every step is written, so lineage stays short."""
    both = common.saved(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                        "near-edges")
    labels = both.groupBy("a").agg(F.min("b").alias("c")).select(
        F.col("a").alias("f"), F.least("a", "c").alias("c"))
    labels = common.saved(labels, "near-labels")
    while True:
        seen = (both.join(labels.withColumnRenamed("f", "b"), "b")
                .groupBy("a").agg(F.min("c").alias("m")).withColumnRenamed("a", "f"))
        low = labels.join(seen, "f").select("f", "c", F.least("c", "m").alias("n"))
        low = common.saved(low, "near-low")
        jump = low.select(F.col("f").alias("n"), F.col("n").alias("j"))
        new = common.saved(low.join(jump, "n", "left").select(
            "f", "c", F.least("n", F.coalesce("j", "n")).alias("n")), "near-jump")
        labels = new.select("f", F.col("n").alias("c"))
        if not new.filter(F.col("n") != F.col("c")).limit(1).count():
            return labels


def _unlinked(members: DataFrame, labels: DataFrame, sets: DataFrame, threshold: float) -> DataFrame | None:
    """Pairs ``a, b`` of one bucket and different classes that may still be
    linked; None if every bucket is within one class.

    A member outside its hub's class is compared with all members of other
    classes, unless the two cannot reach the threshold: shingles that no other
    set has are in no common weight, and the others' common weight is at most
    the smaller one, bin by bin of their hashes.  An edited copy that its hub did
    not link differs too much from other copies as well, so a large group of
    copies leaves few pairs.
    """
    named = members.join(labels, "f", "left").select("band", "f", "hub", F.coalesce("c", "f").alias("c"))
    named = common.saved(named, "near-named")
    open_ = named.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.max(
        F.when(F.col("f") == F.col("hub"), F.col("c"))).alias("top")).filter(F.col("x") != F.col("y"))
    rest = common.saved(named.select("band", "f", "c").join(
        common.saved(open_.select("band", "top"), "near-open"), "band"), "near-rest")
    if not rest.limit(1).count():
        return None

    def spread(batches):
        for pdf in batches:
            parts = [(f, *_unpacked(x)) for f, x in zip(pdf["f"], pdf["set"])]
            if parts:
                yield pd.DataFrame({"f": np.repeat(np.array([p[0] for p in parts], object), [len(p[1]) for p in parts]),
                                    "h": np.concatenate([p[1] for p in parts]).view(np.int64),
                                    "w": np.concatenate([p[2] for p in parts])})

    involved = sets.join(rest.select("f").distinct(), "f", "left_semi")
    parts = common.saved(involved.mapInPandas(spread, "f binary, h long, w float"), "near-spread")
    own = (parts.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.first("f").alias("f"), F.first("w").alias("w"))
           .filter(F.col("n") == 1).select("f", "h", F.lit(True).alias("own")))
    own = common.saved(own, "near-own")
    binned = (parts.join(own, ["f", "h"], "left").withColumn("bin", F.col("h").bitwiseAND(BINS - 1))
              .groupBy("f", "bin").agg(F.sum("w").alias("w"), F.sum(F.when(F.col("own").isNull(), F.col("w"))).alias("x")))
    filled = F.map_from_entries(F.collect_list(F.struct("bin", F.coalesce("x", F.lit(0.0)).alias("x"))))
    known = binned.groupBy("f").agg(F.sum("w").alias("w"), filled.alias("m")).select(
        "f", "w", F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.coalesce(
            F.element_at("m", i.cast("long")), F.lit(0.0)).cast("float")).alias("v"))
    known = common.saved(known, "near-weights")
    rest = common.saved(rest.join(known, "f"), "near-known")
    left = rest.filter(F.col("c") != F.col("top")).select(F.col("band").alias("band_a"), F.col("f").alias("a"), F.col("c").alias("ca"),
                                                          F.col("w").alias("wa"), F.col("v").alias("va"))
    right = rest.select("band", F.col("f").alias("b"), F.col("c").alias("cb"), F.col("w").alias("wb"),
                        F.col("v").alias("vb"), "top")
    # Two members outside the hub's class meet once.
    once = (F.col("cb") == F.col("top")) | (F.col("a") < F.col("b"))
    most = F.expr("aggregate(zip_with(va, vb, (x, y) -> least(x, y)), 0.0D, (s, x) -> s + x)")
    possible = most * (1 + 1 / threshold) * (1 + 1e-5) >= F.col("wa") + F.col("wb")
    met = left.join(right, (F.col("band_a") == F.col("band")) & (F.col("ca") != F.col("cb")) & once & possible)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_ROWS = "_k1 long, _k2 long, doc_id long, f binary, bins binary, bands array<long>"


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(rows, labels)``.  ``rows``: ``_k1, _k2, doc_id, f`` per row of
    ``docs`` (``f``: node, null for texts without words).  ``labels``: ``f, c``
    for nodes linked to a different text."""
    common.prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(fit_sampler(docs, text_col))
    k1, k2 = common.row_key(id_col, text_col)
    keyed = docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("t"))

    def sample(batches):
        for pdf in batches:
            fs, bins, bands = [], [], []
            for found, h in runs(pdf["t"]):
                if not found:
                    fs.append(None), bins.append(None), bands.append(None)
                    continue
                h, tf = np.unique(h, return_counts=True)
                fs.append(hashlib.blake2b(" ".join(found).encode("utf-8", "surrogatepass"),
                                          digest_size=16).digest())
                bins.append(binned(h, held.value.weights(h, tf)[1]).tobytes())
                bands.append(band_keys(held.value.signature(h, tf)))
            yield pd.DataFrame({"_k1": pdf["_k1"], "_k2": pdf["_k2"], "doc_id": pdf["doc_id"].astype("Int64"),
                                "f": fs, "bins": bins, "bands": bands})

    rows = common.saved(keyed.mapInPandas(sample, _ROWS), "near-rows")
    nodes = rows.filter(F.col("f").isNotNull()).groupBy("f").agg(
        F.first("bins").alias("bins"), F.first("bands").alias("bands"),
        F.min(F.struct("_k1", "_k2")).alias("at"))
    nodes = common.saved(nodes, "near-nodes")
    members = nodes.select("f", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    members = common.saved(members.join(common.saved(shared, "near-shared"), "band"), "near-members")
    # A bucket's hubs: its most central node, which meets most others in all its
    # buckets (the text that others are copies of, if it is there), and its least.
    central = common.saved(members.groupBy("f").agg(F.sum("n").alias("score")), "near-central")
    hubs = members.join(central, "f").groupBy("band").agg(
        F.max(F.struct("score", "f")).getField("f").alias("hub"), F.min("f").alias("low"))
    members = common.saved(members.select("f", "band").join(common.saved(hubs, "near-hubs"), "band"), "near-met")

    # Packed sets of the nodes that share a bucket with another.
    needed = members.select("f").distinct().join(nodes.select("f", "at._k1", "at._k2"), "f")
    needed = common.saved(needed, "near-needed")

    def pack(batches):
        for pdf in batches:
            out = []
            for _, h in runs(pdf["t"]):
                h, tf = np.unique(h, return_counts=True)
                out.append(_packed(h, held.value.weights(h, tf)[1]))
            yield pd.DataFrame({"f": pdf["f"], "set": out})

    texts = keyed.select("_k1", "_k2", "t").join(needed.hint("shuffle_hash"), ["_k1", "_k2"])
    sets = common.saved(texts.select("f", "t").mapInPandas(pack, "f binary, set binary")
                        .dropDuplicates(["f"]), "near-sets")

    to_hubs = members.select("f", F.explode(F.array_distinct(F.array("hub", "low"))).alias("to"))
    pairs = to_hubs.filter(F.col("f") != F.col("to")).select(
        F.least("f", "to").alias("a"), F.greatest("f", "to").alias("b")).distinct()
    edges = common.saved(_agreeing(pairs, nodes, sets, threshold), "near-links")
    labels = components(edges)
    more = _unlinked(members, labels, sets, threshold)
    if more is not None:
        edges = common.saved(edges.union(_agreeing(more, nodes, sets, threshold)), "near-all-links")
        labels = components(edges)
    return rows.select("_k1", "_k2", "doc_id", "f"), labels


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` plus the class node ``c`` (null for texts without words)."""
    return rows.join(labels, "f", "left").select(
        "_k1", "_k2", "doc_id", F.coalesce("c", "f").alias("c"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, class_size`` per row: the least id among the
    documents linked, by any chain, through weighted similarities of at least
    ``threshold``, and their number.

    Texts without words (null, empty, punctuation) are classes of their own.
    Texts of fewer than five words are one shingle.  Repeated rows are in one
    class.  An id column must be numeric; a class of rows without ids has a
    null id.
    """
    named = common.saved(_named(*classes(docs, id_col, text_col, threshold)), "near-classes")
    groups = named.filter(F.col("c").isNotNull()).groupBy("c").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    groups = common.saved(groups, "near-groups")
    out = named.join(groups, "c", "left")
    alone = F.col("c").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the one with the least id (nulls
    last), then the least row key.  Texts without words all stay."""
    named = common.saved(_named(*classes(docs, id_col, text_col, threshold)), "near-classes")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "_k1", "_k2")
    first = named.filter(F.col("c").isNotNull()).groupBy("c").agg(F.min(rank).alias("r"))
    kept = common.saved(first.select("r._k1", "r._k2"), "near-kept")
    # Keys of texts without words are not in any class, and all stay.
    alone = common.saved(named.filter(F.col("c").isNull()).select("_k1", "_k2").distinct(), "near-alone")
    keyed = common.packed(docs, id_col, text_col)
    # Repeated rows share a key: one of them stays.
    one = (keyed.join(kept.hint("shuffle_hash"), ["_k1", "_k2"], "left_semi")
           .dropDuplicates(["_k1", "_k2"]))
    if alone.limit(1).count():
        one = one.unionByName(keyed.join(alone.hint("shuffle_hash"), ["_k1", "_k2"], "left_semi"))
    return common.unpacked(one, docs)


def op10_minhash_neardup(spark, sf_dir):
    return near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
