"""Line quality with a linear-chain conditional random field.

Method: every line of a document is labelled good or bad.  A line's features
describe its characters and words and those of its neighbours; the chain ties
labels of consecutive lines.  Forward-backward gives each line's marginal, the
length-weighted mean of the marginals is the document's quality, and a logistic
fit of that mean to the training labels puts it on a probability scale.

The field is fitted by gradient ascent on a bounded sample of labelled
documents: whole ones, up to ``TRAIN_DOCS`` with the smallest hash of their id
among the rows that are not held out and have at most ``TRAIN_LINES`` lines.
Its parameters are a few dozen numbers.  Scoring is a column function without a
shuffle: whole texts, a few numbers a line.
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

TRAIN_DOCS = 3000
TRAIN_LINES = 500
STEPS = 150
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
BATCH_CELLS = 400_000  # lines padded together when scoring
BATCH_LINES = 20_000   # lines of the texts scored at once, unless one text has more
_PUNCT = re.compile(r"[#$%&*|~^=_<>{}\[\]\\@/+]")
_DIGIT = re.compile(r"[0-9]")
_TAIL = re.compile(r"[#$%&*|!]{2,}(?=\s|$)")


N_LINE = 17
N_FEATURES = 3 * N_LINE + 3


def line_features(line: str) -> list[float]:
    """Rates of one line; all but the first are 0 for a blank line."""
    words = line.split()
    n, w = len(line), len(words)
    if not w:
        return [1.0] + [0.0] * (N_LINE - 1)
    symbols = len(_PUNCT.findall(line))
    marks = line.count("!")
    upper = sum(map(str.isupper, words))
    lengths = n / w
    return [
        0.0,
        min(np.log1p(n) / 8, 2.0),
        min(np.log1p(w) / 6, 2.0),
        min(lengths / 10, 3.0),
        min(symbols / w, 3.0),
        min(marks / w, 3.0),
        upper / w,
        len(_DIGIT.findall(line)) / n,
        len(set(words)) / w,
        min(line.count("|") / w, 1.0),
        len(_TAIL.findall(line)) / w,
        float(line.rstrip()[-1] in ".!?:;\"'"),
        float(w < 4),
        sum(map(len, filter(str.isalpha, words))) / n,
        min((line.count(",") + line.count(".")) / w, 1.0),
        float(line[0].isspace()),
        sum(map(eq, words, words[1:])) / w,
    ]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``(features, lengths)`` of a document's lines: own rates, those of the
    line before and the line after, and whether there is one."""
    lines = (text or "").split("\n")
    own = np.array([line_features(x) for x in lines], dtype=np.float64)
    k = len(lines)
    f = np.zeros((k, N_FEATURES))
    f[:, 0] = 1.0
    f[:, 3:3 + N_LINE] = own
    f[1:, 3 + N_LINE:3 + 2 * N_LINE] = own[:-1]
    f[:-1, 3 + 2 * N_LINE:] = own[1:]
    f[0, 1] = 1.0
    f[-1, 2] = 1.0
    return f, np.array([max(len(x), 1) for x in lines], dtype=np.float64)


def _logaddexp_pair(a):
    return np.logaddexp(a[..., 0], a[..., 1])


def marginals(emit: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Forward-backward over padded chains.  ``emit``: documents x lines, the
    score of good over bad.  Returns ``(P(good), expected transitions)``, the
    latter summed per document."""
    d, t = emit.shape
    e = np.stack([np.zeros_like(emit), emit], axis=2)
    alpha, beta = np.zeros((d, t, 2)), np.zeros((d, t, 2))
    alpha[:, 0] = e[:, 0]
    for i in range(1, t):
        step = _logaddexp_pair((alpha[:, i - 1, :, None] + trans).transpose(0, 2, 1)) + e[:, i]
        alpha[:, i] = np.where(mask[:, i, None], step, alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        step = _logaddexp_pair(trans + (e[:, i + 1] + beta[:, i + 1])[:, None, :])
        beta[:, i] = np.where(mask[:, i + 1, None], step, beta[:, i + 1])
    logz = _logaddexp_pair(alpha[:, -1])
    p = np.exp(np.minimum(alpha + beta - logz[:, None, None], 0.0))
    good = p[..., 1] / np.maximum(p.sum(axis=2), 1e-300)
    pair = (alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
            - logz[:, None, None, None])
    pair = np.where(mask[:, 1:, None, None], np.exp(np.minimum(pair, 0.0)), 0.0)
    return good, pair.sum(axis=1)


def _padded(features: list[np.ndarray]):
    t = max(len(f) for f in features)
    x = np.zeros((len(features), t, N_FEATURES))
    mask = np.zeros((len(features), t), bool)
    for i, f in enumerate(features):
        x[i, :len(f)] = f
        mask[i, :len(f)] = True
    return x, mask


class Model:
    """Parameters of the field and of the logistic fit."""

    def __init__(self):
        self.w, self.trans = np.zeros(N_FEATURES), np.zeros((2, 2))
        self.a, self.b = 4.0, -2.0

    def emissions(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """``(score of good over bad, length)`` of each line of a whole text;
        the features are made a block of lines at a time."""
        lines = (text or "").split("\n")
        parts = self.w[3:].reshape(3, N_LINE).T  # own, the line before, the line after
        own = np.concatenate([np.array([line_features(x) for x in lines[at:at + BATCH_LINES]]) @ parts
                              for at in range(0, len(lines), BATCH_LINES)])
        emit = self.w[0] + own[:, 0]
        emit[1:] += own[:-1, 1]
        emit[:-1] += own[1:, 2]
        emit[0] += self.w[1]
        emit[-1] += self.w[2]
        return emit, np.array([max(len(x), 1) for x in lines], dtype=np.float64)

    def means(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean marginal per document (``emissions``), padded
        in groups of similar length."""
        out = np.zeros(len(docs))
        order = sorted(range(len(docs)), key=lambda i: len(docs[i][0]))
        at = 0
        while at < len(order):
            end = at + 1
            # Lines are added while the padded block stays small and even.
            while (end < len(order) and len(docs[order[end]][0]) * (end - at + 1) <= BATCH_CELLS // 10
                   and len(docs[order[end]][0]) <= 2 * len(docs[order[at]][0]) + 8):
                end += 1
            group = [docs[i] for i in order[at:end]]
            t = max(len(f) for f, _ in group)
            emit, mask = np.zeros((len(group), t)), np.zeros((len(group), t), bool)
            for i, (f, _) in enumerate(group):
                emit[i, :len(f)] = f
                mask[i, :len(f)] = True
            good, _ = marginals(emit, mask, self.trans)
            for i, (f, n) in enumerate(group):
                out[order[at + i]] = good[i, :len(f)] @ n / n.sum()
            at = end
        return out

    def scores(self, texts) -> np.ndarray:
        means = self.means([self.emissions(t) for t in texts])
        return 1.0 / (1.0 + np.exp(-(self.a * means + self.b)))


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS,
        ridge: float = 1e-2) -> Model:
    """Maximum conditional likelihood (Adam), every line carrying its
    document's label, a document weighing 1 whatever its length."""
    model = Model()
    if not len(docs):
        return model
    groups, order = [], np.argsort([len(f) for f, _ in docs], kind="stable")
    for part in np.array_split(order, max(1, min(12, len(order) // 50))):
        x, mask = _padded([docs[i][0] for i in part])
        groups.append((x, mask, labels[part].astype(float)))
    theta = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        grad = -ridge * theta
        for x, mask, y in groups:
            n = mask.sum(axis=1)
            good, moves = marginals(x @ theta[:N_FEATURES], mask, theta[N_FEATURES:].reshape(2, 2))
            diff = np.where(mask, y[:, None] - good, 0.0) / n[:, None]
            grad[:N_FEATURES] += np.einsum("dt,dtf->f", diff, x, optimize=True) / len(docs)
            # Transitions: seen (all within the label) minus expected.
            stays = (n - 1) / n
            seen = np.diag([((1 - y) * stays).sum(), (y * stays).sum()])
            grad[N_FEATURES:] += (seen - (moves / n[:, None, None]).sum(axis=0)).ravel() / len(docs)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model.w, model.trans = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
    model.a, model.b = _logistic(model.means([(f @ model.w, n) for f, n in docs]), labels)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method for ``P(y) = 1 / (1 + exp(-(a x + b)))`` with a small ridge."""
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - 0.1 * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta += np.linalg.solve(hess, grad)
    return float(beta[0]), float(beta[1])


def held_out(id_col: str):
    """crc32 of the id as text modulo 5 is 0 (a null id counts as no text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % FOLDS == HELD_OUT


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES,
          steps: int = STEPS) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out:
    at most ``train_docs`` documents of at most ``max_lines`` lines each."""
    common.prepare(docs.sparkSession)
    n_lines = F.length(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "[^\n]", "")) + 1
    docs = docs.filter(n_lines <= max_lines)
    sample = (labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).distinct()
              .sort(F.xxhash64("_id"), "_id", "_y").limit(train_docs))
    schema = "y int, f array<float>, n array<float>"

    def features(batches):
        for pdf in batches:
            rows = [(y, *document_features(t)) for y, t in zip(pdf["_y"], pdf["_t"])]
            yield pd.DataFrame({"y": [r[0] for r in rows], "f": [r[1].ravel().astype(np.float32) for r in rows],
                                "n": [r[2].astype(np.float32) for r in rows]})

    # At most train_docs ids: a broadcast of proven size.
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
             .join(F.broadcast(sample), "_id").sort(F.xxhash64("_id", "_t")).limit(2 * train_docs)
             .select("_y", "_t"))
    got, y = [], []
    for r in texts.mapInPandas(features, schema).toLocalIterator():
        got.append((np.array(r["f"], dtype=np.float64).reshape(-1, N_FEATURES), np.array(r["n"])))
        y.append(r["y"])
    return fit(got, np.array(y), steps)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus the probability of good quality.

    Null and empty texts are one blank line and scored as such; texts of any
    number of lines are scored whole; repeated rows get equal scores; other columns pass through (one named ``out_col`` is
    replaced).
    """
    spark = docs.sparkSession
    common.prepare(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        out, texts, lines = [], [], 0
        for t in text:
            texts.append(t)
            lines += t.count("\n") + 1 if t else 1
            if lines >= BATCH_LINES:
                out.extend(held.value.scores(texts))
                texts, lines = [], 0
        if texts:
            out.extend(held.value.scores(texts))
        return pd.Series(out, dtype=float)

    return docs.withColumn(out_col, scored(F.col(text_col)))


def op3_quality_crf(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels").select("doc_id", "quality"))
    out = score(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      F.when(F.col("score") >= CUT, 1).otherwise(0).cast("int").alias("predicted"))
