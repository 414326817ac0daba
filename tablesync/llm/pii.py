"""PII: information-theoretic sanitisation.

Method: e-mail addresses, IP addresses, card and phone numbers are the protected
entities.  The corpus tells how strongly a term near an entity reveals it: with
``N`` documents, ``df(t)`` documents holding the term, ``d(e)`` holding the
entity and ``c(e, t)`` holding the term within ``CONTEXT`` words of the entity,

    risk(e, t) = PMI(e; t) / IC(e) = log(N c / (df d)) / log(N / d)

is 1 when the term occurs with that entity only, and 0 when the two are
independent.  Terms next to an entity whose risk reaches ``GENERALISE`` become
a class word, from ``REMOVE`` on they go.  Every pair is scored: most protected
values stand in one document only, and a term beside such a value reveals it the
more the fewer documents hold the term, ``risk = 1 - log(df) / log(N)``.

All counts cover all documents and are summed in tasks before a shuffle; the
contexts kept are a few words per entity found, joined back by row key.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common

CONTEXT = 8
MIN_SUPPORT = 1  # documents that must hold a pair: all pairs count unless a caller asks for more
GENERALISE = 0.7
REMOVE = 0.9
FLUSH_TERMS = 500_000  # distinct terms a task holds before it hands them on
KINDS = ("email", "ip", "card", "phone")

# The domain part.  What may stand before the @ is found by walking back, and
# the other patterns start at the head of a digit run: the same matches as the
# plain patterns, in time linear in the text.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_AT = re.compile("@")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{2,}")


def _emails(t):
    done = 0
    for at in _AT.finditer(t):
        a = at.start()
        if a < done:
            continue
        m = _DOMAIN.match(t, a)
        left = t[done:a]
        start = done + len(left.rstrip(_LOCAL))
        if m and start < a:
            yield start, m.end()
            done = m.end()
        else:
            done = a + 1  # an address holds one @, so no later one reaches back


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))
    return (odd + even) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches per kind, in code points, end
    exclusive; matches that fail their kind's test are dropped without a retry."""
    t = text or ""
    out = {k: [] for k in KINDS}
    if "@" in t:
        out["email"] = list(_emails(t))
    for m in _IP.finditer(t):
        if all(_small(p) for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out["card"].append(m.span())
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


def _entity(kind: str, value: str) -> str:
    if kind != "email" and kind != "ip":
        value = re.sub(r"[^0-9]", "", value)
    return hashlib.blake2b(f"{kind}:{value.lower()}".encode(), digest_size=16).hexdigest()


def contexts(text: str, base, width: int = CONTEXT):
    """``(entity, term, start, end, first_pair, first_entity)`` rows: words near
    each base span, within its line and outside all base spans.  An entity
    without such words gives one row with a null term."""
    spans = sorted((a, b, k) for k, v in base.items() for a, b in v)
    heads, tails = [], []  # the spans of all kinds merged
    for a, b, _ in spans:
        if tails and a <= tails[-1]:
            tails[-1] = max(tails[-1], b)
        else:
            heads.append(a)
            tails.append(b)
    out, pairs, entities = [], set(), set()
    end, starts, ends = -1, [], []
    for a, b, kind in spans:
        e = _entity(kind, text[a:b])
        new = e not in entities
        entities.add(e)
        if a >= end:  # the words of the next line that holds a span
            head = text.rfind("\n", 0, a) + 1
            end = text.find("\n", b)
            end = len(text) if end < 0 else end
            line = [m.span() for m in _WORD.finditer(text, head, end)]
            starts, ends = [w[0] for w in line], [w[1] for w in line]
        before, after = bisect_right(ends, a), bisect_left(starts, b)
        words = line[max(0, before - width):before] + line[after:after + width]
        near = [w for w in words if not ((i := bisect_left(heads, w[1])) and w[0] < tails[i - 1])]
        if not near:
            out.append((e, None, -1, -1, False, new))
        for s, t in near:
            term = text[s:t].lower()
            out.append((e, term, s, t, (e, term) not in pairs, new))
            pairs.add((e, term))
            new = False
    return out


_CTX = "array<struct<e:string,t:string,s:int,f:int,fp:boolean,fe:boolean>>"
_SCAN = f"n_email long, n_ip long, n_card long, n_phone long, base string, ctx {_CTX}"


def _scan(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        base = base_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
        rows.append((*(len(base[k]) for k in KINDS), joined, contexts(t, base) if joined else []))
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "ctx"])


def _document_frequencies(docs: DataFrame, text_col: str) -> DataFrame:
    """``term, df`` over all documents; tasks sum before the shuffle."""
    def count(batches):
        seen: Counter = Counter()

        def flush():
            return pd.DataFrame({"term": list(seen.keys()), "n": list(seen.values())})

        for pdf in batches:
            for t in pdf["t"]:
                if t:
                    seen.update(set(_WORD.findall(t.lower())))
                    if len(seen) > FLUSH_TERMS:
                        yield flush()
                        seen.clear()
        if seen:  # an empty frame has no string column
            yield flush()

    counted = docs.select(F.col(text_col).alias("t")).mapInPandas(count, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("df"))


def disclosures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                generalise: float = GENERALISE, remove: float = REMOVE,
                min_support: int = MIN_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """``(found, added)``.  ``found``: one row per row of ``docs`` with its key,
    id, counts and base spans.  ``added``: ``_k1, _k2, added``, per row key the
    sorted spans ``(start, end, kind)`` of disclosing terms, kind ``general``
    or ``remove``."""
    common.prepare(docs.sparkSession)
    k1, k2 = common.row_key(id_col, text_col)
    found = common.saved(docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(id_col).alias("doc_id"),
                                     F.pandas_udf(_scan, _SCAN)(F.col(text_col)).alias("r"))
                         .select("_k1", "_k2", "doc_id", "r.*"), "pii-found")
    near = found.select("_k1", "_k2", F.explode("ctx").alias("x")).select("_k1", "_k2", "x.*")
    total = found.count()
    entities = near.filter("fe").groupBy("e").agg(F.count(F.lit(1)).alias("d"))
    pairs = (near.filter("fp").groupBy("e", "t").agg(F.count(F.lit(1)).alias("c"))
             .filter(F.col("c") >= min_support))
    pairs = common.saved(pairs.join(entities, "e"), "pii-pairs")
    terms = pairs.select(F.col("t").alias("term")).distinct()
    df = _document_frequencies(docs, text_col).join(terms, "term", "left_semi")
    scored = pairs.join(df, pairs["t"] == df["term"])
    n = F.lit(float(max(total, 1)))
    ic = F.log(n / F.col("d"))
    pmi = F.log(n * F.col("c") / (F.col("df") * F.col("d")))
    risk = F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))
    risky = common.saved(scored.select("e", "t", risk.alias("risk")).filter(F.col("risk") >= generalise),
                         "pii-risky")
    hit = near.join(risky, ["e", "t"])
    worst = hit.groupBy("_k1", "_k2", "s", "f").agg(F.max("risk").alias("risk"))
    kind = F.when(F.col("risk") >= remove, "remove").otherwise("general")
    added = worst.groupBy("_k1", "_k2").agg(
        F.sort_array(F.collect_list(F.struct("s", "f", kind.alias("kind")))).alias("added"))
    return found, added


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with the text sanitised: base spans become ``<EMAIL>`` ..
    ``<PHONE>``, disclosing terms become ``<TERM>`` or go.

    Null and empty texts stay; repeated rows count as documents each and come
    out alike; other columns pass through whatever their names.  Overlapping
    spans are merged under the first one's word.
    """
    found, added = disclosures(docs, id_col, text_col, **thresholds)
    added = common.saved(added, "pii-added")

    @F.pandas_udf("string")
    def rewrite(text: pd.Series, added: pd.Series) -> pd.Series:
        out = []
        for t, more in zip(text, added):
            if not t:
                out.append(t)
                continue
            spans = [(a, b, f"<{k.upper()}>") for k, v in base_spans(t).items() for a, b in v]
            spans += [(x["s"], x["f"], "<TERM>" if x["kind"] == "general" else "")
                      for x in (more if more is not None else [])]
            parts, at = [], 0
            for a, b, word in sorted(spans):
                if a >= at:
                    parts += [t[at:a], word]
                at = max(at, b)
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    joined = common.packed(docs, id_col, text_col).join(added.hint("shuffle_hash"), ["_k1", "_k2"], "left")
    text = rewrite(F.col("_row").getField(text_col), F.col("added"))
    return common.unpacked(joined, docs, **{text_col: text})


def op1_pii_sanitise(spark, sf_dir):
    found, added = disclosures(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = found.join(added, ["_k1", "_k2"], "left")
    terms = F.expr("transform(array_sort(coalesce(added, array()), (a, b) -> CASE "
                   "WHEN a.kind < b.kind THEN -1 WHEN a.kind > b.kind THEN 1 ELSE a.s - b.s END), "
                   "x -> concat_ws(':', x.kind, x.s, x.f))")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.array_join(terms, ","))
    spans = F.when(F.size(F.coalesce("added", F.array())) > 0, spans).otherwise(F.col("base"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans"),
                      F.size(F.coalesce("added", F.array())).cast("long").alias("n_terms"))
