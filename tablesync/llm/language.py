"""Language identification by Bayesian evidence fusion.

Method: a text's likelihood under each language comes from letter trigrams.  It
is combined with what else is known of a page: the language its markup
declares, the suffix of its address, and a prior of its host.  How far a
declaration or a suffix can be trusted is itself counted: tables of declared
value by language over all rows.  Host priors are grouped sums of the text
posteriors, smoothed towards their domain, which is smoothed towards the whole
corpus.  A row's own posterior is taken out of each count before it is used.

One more hypothesis, ``und``, stands for all that no label is like: every
trigram bucket equally likely.  It is fused as a language is, so a text whose
trigrams a language explains worse than chance is ``und``, not the label that
happens to give unseen trigrams the largest share.

Every label is a language.  Trigrams are counted in a table of fixed size per
language, fitted on a bounded sample of labelled texts (``TRAIN_ROWS`` per
language) by grouped sums; all other counts cover
all rows and are grouped aggregations.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm import common
from tablesync.llm.html_text import parse, render

TRAIN_ROWS = 1000       # labelled texts per language; bounds what the driver gets
LANGUAGE_BLOCK = 64     # languages a text is scored against at once
BUCKETS = 1 << 15
EVIDENCE = 0.1          # trigrams of a text overlap: each counts as a tenth
HOST_MASS, DOMAIN_MASS, TABLE_MASS = 20.0, 50.0, 5.0
MIN_POSTERIOR = 0.5
UNKNOWN = "und"

_LANG = re.compile(r"\s*([A-Za-z]{2,3})")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the letter trigrams of a text; other characters count as one
    blank between words."""
    if not text:
        return np.empty(0, np.int64)
    t = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    if not t:
        return np.empty(0, np.int64)
    c = np.frombuffer(f" {t} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B1) ^ c[1:-1] * np.uint64(0x85EBCA77) ^ c[2:] * np.uint64(0xC2B2AE3D))
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)
    return h.astype(np.int64)


class Model:
    """Log probabilities of trigram buckets by language, ``und`` the last."""

    def __init__(self, languages: list[str], counts: list[np.ndarray]):
        """``counts``: per language the rows ``(bucket, count)`` of those seen."""
        self.languages = [*languages, UNKNOWN] if languages else []
        self.logs = np.empty((len(languages) + 1, BUCKETS), np.float32)
        for i, seen in enumerate([*counts, np.empty((0, 2), np.int64)]):
            smooth = np.full(BUCKETS, 0.5)
            smooth[seen[:, 0]] += seen[:, 1]
            self.logs[i] = np.log(smooth / smooth.sum())

    def posterior(self, text: str | None) -> tuple[int, list[float]]:
        """Number of trigrams and the text's posterior under even priors."""
        k = len(self.languages)
        grams = trigrams(text)
        if not len(grams) or not k:
            return 0, [1.0 / max(k, 1)] * k
        at, n = np.unique(grams, return_counts=True)
        ll = EVIDENCE * np.concatenate([self.logs[i:i + LANGUAGE_BLOCK, at].astype(np.float64) @ n
                                        for i in range(0, k, LANGUAGE_BLOCK)])
        p = np.exp(ll - ll.max())
        return len(grams), (p / p.sum()).tolist()


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        train_rows: int = TRAIN_ROWS) -> Model:
    """A model from the distinct texts with the smallest hashes of each language."""
    rows = labelled.filter(F.col(text_col).isNotNull() & (F.col(lang_col) != UNKNOWN)).select(
        F.col(lang_col).alias("l"), F.shiftrightunsigned(F.xxhash64(text_col), 2).alias("h"),
        F.col(text_col).alias("t"))
    # Hashes are even, so a share of them holds about twice the rows wanted:
    # one pass hands on a bounded number of texts a label, whatever the table's size.
    share = F.least(F.lit(2.0 * train_rows) / F.count(F.lit(1)), F.lit(1.0)) * float(1 << 62)
    sizes = common.saved(rows.groupBy("l").agg(share.cast("long").alias("s")).withColumnRenamed("l", "_l"), "lang-sizes")
    picked = common.saved(rows.join(sizes, (F.col("l") == F.col("_l")) & (F.col("h") < F.col("s")))
                          .select("l", "h", "t").distinct(), "lang-sample")
    first = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    texts = picked.withColumn("r", first).filter(F.col("r") <= train_rows).select("l", "t")
    per_label = (texts.mapInPandas(_bucket_counts, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n"))
                 .groupBy("l").agg(F.collect_list(F.struct("b", "n")).alias("c")))
    counts = {}
    for r in common.saved(per_label, "lang-counts").toLocalIterator():
        counts[r[0]] = np.array(r[1], dtype=np.int64).reshape(-1, 2)
    return Model(sorted(counts), [counts[name] for name in sorted(counts)])


def _bucket_counts(batches):
    """``l, b, n``: trigrams per bucket of each run of rows of one label."""
    for pdf in batches:
        for name, texts in pdf.groupby("l")["t"]:
            counts = np.zeros(BUCKETS, np.int64)
            for t in texts:
                counts += np.bincount(trigrams(t), minlength=BUCKETS)
            b = np.flatnonzero(counts)
            if len(b):
                yield pd.DataFrame({"l": name, "b": b.astype(np.int32), "n": counts[b]})


def page_evidence(html: str | None, url: str | None):
    """Text, declared language, host, domain and suffix of a page."""
    root = parse(html or "")
    m = _LANG.match(root.attrs.get("lang") or root.attrs.get("xml:lang") or "")
    h = _HOST.match(url or "")
    host = h[1].lower() if h else None
    parts = host.split(".") if host else []
    return (render(root), m[1].lower() if m else None, host,
            ".".join(parts[-2:]) if parts else None, parts[-1] if len(parts) > 1 else None)


def _vector(name: str, k: int):
    return [F.get(F.col(name), i) for i in range(k)]


def _sums(rows: DataFrame, keys: list[str], k: int, out: str) -> DataFrame:
    """``keys`` and the sum of the posteriors as an array ``out``."""
    sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(f"_s{i}") for i, c in enumerate(_vector("p", k))])
    return sums.select(*keys, F.array(*[F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) for i in range(k)]).alias(out))


def fuse(rows: DataFrame, languages: list[str], min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Adds ``language, posterior`` to rows with ``n, p`` (trigrams and text
    posterior) and evidence ``declared, suffix, host, domain`` (nulls: none).

    ``rows`` must be cheap to read more than once (a written table).
    """
    k = len(languages)
    if not k:
        return rows.withColumn("language", F.lit(UNKNOWN)).withColumn("posterior", F.lit(0.0))
    known = rows.filter(F.col("n") > 0)
    # One number per language, over all rows.
    whole = np.array(_sums(known, [], k, "all_").first()["all_"])
    tables = {"declared": "by_declared", "suffix": "by_suffix", "host": "by_host", "domain": "by_domain"}
    joined = rows
    for key, name in tables.items():
        t = common.saved(_sums(known.filter(F.col(key).isNotNull()), [key], k, name)
                         .withColumnRenamed(key, f"_{key}"), f"lang-{key}")
        joined = joined.join(t, joined[key] == t[f"_{key}"], "left").drop(f"_{key}")

    @F.pandas_udf("language string, posterior double")
    def fused(n: pd.Series, p: pd.Series, declared: pd.Series, suffix: pd.Series, host: pd.Series,
              domain: pd.Series) -> pd.DataFrame:
        best, name = posteriors(n.to_numpy(), _stacked(p, k), whole, *(
            _stacked(x, k) for x in (declared, suffix, host, domain)))
        sure = (n.to_numpy() > 0) & (best >= min_posterior)
        return pd.DataFrame({"language": [languages[i] if y else UNKNOWN for i, y in zip(name, sure)],
                             "posterior": best})

    return joined.withColumn("_f", fused("n", "p", *tables.values())).select(
        "*", "_f.language", "_f.posterior").drop("_f", *tables.values())


def _stacked(arrays: pd.Series, k: int) -> np.ndarray:
    """A matrix of rows; a missing array is a row of NaN."""
    none = np.full(k, np.nan)
    return np.array([none if x is None else x for x in arrays], dtype=float).reshape(-1, k)


def posteriors(n, p, whole, declared, suffix, host, domain) -> tuple[np.ndarray, np.ndarray]:
    """Best posterior and its language per row, from summed counts by declared
    value, suffix, host and domain (rows of NaN: no such evidence)."""
    own = np.where(n[:, None] > 0, p, 0.0)

    def others(counts):
        return np.maximum(np.nan_to_num(counts) - own, 0.0)

    every = np.maximum(whole - own, 0.0)
    prior = (every + 1.0) / (every.sum(axis=1, keepdims=True) + p.shape[1])
    for counts, mass in ((domain, DOMAIN_MASS), (host, HOST_MASS)):
        c = others(counts)
        prior = (c + mass * prior) / (c.sum(axis=1, keepdims=True) + mass)
    raw = prior * np.maximum(p, 1e-30)
    for counts in (declared, suffix):
        c = others(counts)
        # P(value | language), drawn towards the value's share of all rows.
        share = c.sum(axis=1, keepdims=True) / (every.sum(axis=1, keepdims=True) + 1.0)
        likelihood = (c + TABLE_MASS * share + 1e-6) / (every + TABLE_MASS)
        raw *= np.where(np.isnan(counts), 1.0, likelihood)
    raw /= raw.sum(axis=1, keepdims=True)
    return raw.max(axis=1), raw.argmax(axis=1)


_EVIDENCE = "n long, p array<double>, declared string, suffix string, host string, domain string"


def identify_pages(pages: DataFrame, model: Model, html_col: str = "html", url_col: str = "url",
                   id_col: str = "page_id", min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``page_id, language, posterior, declared, host, n`` per page.

    Pages without letters, null or empty pages, pages unlike all labels and pages
    whose best language stays under ``min_posterior`` are ``und``.  A null address or a missing
    declaration is no evidence.  Repeated rows count and are judged each.
    """
    spark = pages.sparkSession
    common.prepare(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_EVIDENCE)
    def evidence(html: pd.Series, url: pd.Series) -> pd.DataFrame:
        out = []
        for h, u in zip(html, url):
            text, declared, host, domain, suffix = page_evidence(h, u)
            out.append((*held.value.posterior(text), declared, suffix, host, domain))
        return pd.DataFrame(out, columns=["n", "p", "declared", "suffix", "host", "domain"])

    rows = common.saved(pages.select(F.col(id_col).alias("page_id"),
                                     evidence(F.col(html_col), F.col(url_col)).alias("e"))
                        .select("page_id", "e.*"), "lang-evidence")
    return fuse(rows, model.languages, min_posterior).select(
        "page_id", "language", "posterior", "declared", "host", "n")


def identify_documents(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str | None = "lang",
                       source_col: str = "source", id_col: str = "doc_id",
                       min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``_k1, _k2, language, posterior`` per row of ``docs``: the declared
    language is ``lang_col``, the host is the source, there is no address."""
    spark = docs.sparkSession
    common.prepare(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("n long, p array<double>")
    def evidence(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.posterior(t) for t in text], columns=["n", "p"])

    k1, k2 = common.row_key(id_col, text_col, lang_col, source_col)
    none = F.lit(None).cast("string")
    rows = common.saved(
        docs.select(k1.alias("_k1"), k2.alias("_k2"), evidence(F.col(text_col)).alias("e"),
                    F.lower(F.col(lang_col)).alias("declared"), none.alias("suffix"),
                    F.col(source_col).alias("host"), none.alias("domain"))
        .select("_k1", "_k2", "e.*", "declared", "suffix", "host", "domain"), "lang-evidence")
    return fuse(rows, model.languages, min_posterior).select("_k1", "_k2", "language", "posterior")


def keep_identified(docs: DataFrame, model: Model, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``docs`` without the rows whose language stays ``und``: texts without
    letters (null and empty ones among them), texts unlike all labels and texts
    that fit no language better than the rest together."""
    judged = identify_documents(docs, model, min_posterior=min_posterior)
    out = judged.filter(F.col("language") == UNKNOWN).select("_k1", "_k2").distinct()
    out = common.saved(out, "lang-rejected")
    keyed = common.packed(docs, "doc_id", "text", "lang", "source")
    return common.unpacked(keyed.join(out.hint("shuffle_hash"), ["_k1", "_k2"], "left_anti"), docs)


def op9_language_id(spark, sf_dir):
    model = fit(common.table(spark, sf_dir, "documents"))
    return identify_pages(common.table(spark, sf_dir, "pages"), model)
