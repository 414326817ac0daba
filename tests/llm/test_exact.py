"""Operators with an exact definition, against plain brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import decontam, line_dedup, mixing, pii, suffix_dedup, topk

from . import awkward

BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def same(df, docs):
    """Extra columns come back as they were."""
    assert df.columns == docs.columns and dict(df.dtypes) == dict(docs.dtypes)


# -------------------------------------------------------------------- op 7
def brute_lines(rows, min_chars=40, min_docs=5):
    holders = collections.defaultdict(set)
    for r in rows:
        for x in (r[1] or "").split("\n"):
            holders[ascii_lower(x.strip(BLANKS))].add(r[0])
    out = []
    for r in rows:
        kept = []
        for x in (r[1] or "").split("\n"):
            k = ascii_lower(x.strip(BLANKS))
            ids = holders[k]
            top = max((i for i in ids if i is not None), default=None)
            if len(k) < min_chars or len(ids) < min_docs or r[0] == top:
                kept.append(x)
        out.append((r[0], None if r[1] is None else "\n".join(kept)))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_lines_match_brute_force(spark):
    df = awkward.docs(spark)
    out = line_dedup.dedup_lines(df)
    same(out, df)
    got = [(r.doc_id, r.text) for r in out.collect()]
    want = brute_lines(awkward.rows())
    assert sorted(got, key=key) == sorted(want, key=key) and sum(a != b[:2] for a, b in zip(want, awkward.rows())) >= 4
    assert sorted(r["_k1"] or "" for r in out.collect()) == sorted(r[5] or "" for r in awkward.rows())


def test_lines_of_long_documents_and_bit_edges(spark):
    rnd = random.Random(3)
    common = [f"common line number {i} " + "x" * 30 for i in range(150)]
    rows = []
    for d in range(12):
        lines = [rnd.choice(common) if rnd.random() < 0.6 else f"{d} {i}" for i in range(rnd.choice([1, 63, 64, 65, 400]))]
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == dict(brute_lines(rows))
    words = line_dedup.drop_bitmaps(df).collect()
    assert all(w.bits != 0 for r in words for w in r.drop_words)  # empty words are left out


def test_lines_keep_by_the_sorted_stream(spark):
    plan = line_dedup.shared_lines(awkward.docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    order = plan.index("monotonically_increasing_id"), plan.index("Sort ["), plan.index("RepartitionByExpression")
    assert order == tuple(sorted(order))  # numbered on top of the sort, that on the range partitions
    assert "max(" not in plan


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(awkward.empty(spark)).count() == 0


# -------------------------------------------------------------------- op 4
def test_mix_comes_near_its_targets(spark):
    df = awkward.docs(spark)
    got = mixing.mix(df).collect()
    assert len(got) == len(awkward.rows())
    words = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in awkward.rows())
    assert sorted(r["size"] for r in got) == words
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    goals = mixing.targets(mixing.sized(df)).collect()
    assert len(goals) == 4 and sum(r.target for r in goals) == pytest.approx(1.5 * sum(words))
    assert {(r.source_size, r.target) for r in got} == {(r.source_size, r.target) for r in goals}
    again = sorted(tuple(r) for r in mixing.mix(df).select("size", "target", "taken").collect())
    assert again == sorted((r["size"], r.target, r.taken) for r in got)


def test_mix_thresholds_are_near_nested_and_capped(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randrange(1, 30), rnd.choice(["a", "a", "a", "b", "c", "ä", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    src = {r[0]: r[2] for r in rows}
    by = collections.defaultdict(list)
    for r in got:
        by[src[r.doc_id]].append(r)
    order = [*sorted(k for k in by if k is not None), None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    size = {s: sum(r["size"] for r in by[s]) for s in by}
    # The stated rule, step by step.
    total, full = 1.5 * sum(size.values()), {}
    while True:
        rest = total - sum(2 * size[s] for s in full)
        free = [s for s in by if s not in full]
        goal = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > 2 * size[s]]
        if not over:
            break
        full.update(dict.fromkeys(over))
    for s, rs in by.items():
        target = 2 * size[s] if s in full else goal[s]
        assert rs[0].target == pytest.approx(target) and rs[0].source_size == size[s]
        assert abs(sum(r.taken for r in rs) - target) <= 15
    more = {r.doc_id: r.taken for r in mixing.mix(df, total_share=1.7).collect()}
    assert all(more[r.doc_id] >= r.taken for r in got if src[r.doc_id] not in full)


def test_mix_of_equal_and_empty_rows(spark):
    same_rows = spark.createDataFrame([(1, "a b c", "s")] * 50, "doc_id long, text string, source string")
    assert {r.taken for r in mixing.mix(same_rows).collect()} in ({3}, {6})
    none = spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(none).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(awkward.empty(spark)).count() == 0


# -------------------------------------------------------------------- op 6
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items, window=13):
    words = WORD.findall(ascii_lower(text or ""))
    hit, names = set(), set()
    for item, t in items:
        w = WORD.findall(ascii_lower(t or ""))
        n = min(window, len(w))
        runs = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in runs:
                hit.update(range(i, i + n))
                names.add(str(item))
    return len(words), len(hit), len(names), ",".join(sorted(names))


@pytest.mark.parametrize("block_words", [500_000, 20])
def test_contamination_matches_brute_force(spark, block_words):
    rnd = random.Random(11)
    vocab = ["un", "deux", "TROIS", "été", "x1", "y-2", "Zed", "o"]
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, make(rnd.choice([3, 13, 14, 40]))) for i in range(12)] + [(50, None), (51, "?!"), (3, "dup dup")]
    rows = [(i, make(rnd.randrange(0, 60)) + " " + (rnd.choice(items)[1] or "")[rnd.randrange(5):] + ".") for i in range(80)]
    rows += [(None, None), (98, ""), (99, items[2][1]), (99, items[2][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_c", F.lit(1)).withColumn("n_hit", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.judge(df, bench, block_words=block_words).select("_row.*", "_c.*").toDF(
        "doc_id", "text", "x", "y", "n_words", "n_hit", "n_items", "sha", "bad").collect()
    assert len(got) == len(rows)
    for r in got:
        n, h, k, names = brute_hits(r.text, items)
        assert (r.n_words, r.n_hit, r.n_items, r.sha, r.bad) == (
            n, h, k, hashlib.sha256(names.encode()).hexdigest(), h > 0 and 20 * h >= n)
    clean = decontam.decontaminate(df, bench)
    same(clean, df)
    assert clean.count() == sum(not r.bad for r in got)


def test_hits_map_back_to_the_original(spark):
    m = decontam.Matcher([("q", "Alpha, beta; GAMMA!")])
    text = "Say: ALPHA -- beta gamma. Été alpha beta gamma"
    assert [text[a:b] for a, b in m.spans(text)] == ["ALPHA -- beta gamma", "alpha beta gamma"]
    assert m.spans(None) == [] and decontam.Matcher([]).scan("a b")[0] == 2


def test_contamination_of_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, awkward.LINE)], "item_id long, text string")
    df = awkward.docs(spark)
    kept = decontam.decontaminate(df, bench)
    same(kept, df)
    assert 0 < kept.count() < df.count()
    assert decontam.decontaminate(df, bench.limit(0)).count() == df.count()
    assert decontam.decontaminate(awkward.empty(spark), bench).count() == 0


# -------------------------------------------------------------------- op 5
def brute_bytes(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i] += 1
                gone[min(i + length, len(d))] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((len(d), int(mask.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~mask])))
    return out


def repeating_texts(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé ") for _ in range(rnd.choice([60, 90, 200]))) for _ in range(6)]
    texts = [None, "", "a" * 300, "ab" * 100]
    for _ in range(50):
        texts.append("".join(
            rnd.choice(base)[rnd.randrange(30):][:rnd.randrange(20, 180)] if rnd.random() < 0.6
            else "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(50))) for _ in range(rnd.randrange(1, 6))))
    return texts + texts[5:9]


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"filter_anchors": 0}])
def test_repeats_match_brute_force(spark, options):
    texts = repeating_texts(len(options) + 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(suffix_dedup.kept_bytes(df, length=48, **options).select("_row.doc_id", "_r.*").collect())
    want = brute_bytes(texts, 48)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want and sum(w[1] for w in want) > 1000


def test_segments_do_not_depend_on_blocks(monkeypatch):
    data = "".join(random.Random(2).choice("abcd") for _ in range(5000)).encode()
    m, start, n, _ = suffix_dedup.segments(data)
    assert start[0] == 0 and (start[1:] == start[:-1] + n[:-1]).all() and start[-1] + n[-1] == len(data) - 399
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    m2, start2, n2, _ = suffix_dedup.segments(data)
    assert (start2[1:] == start2[:-1] + n2[:-1]).all() and set(m) <= set(m2)


def test_blind_trie_orders_like_sorted():
    rnd = random.Random(9)
    for _ in range(200):
        words = [bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(rnd.randrange(1, 40))]
        trie = suffix_dedup.BlindTrie()
        for i, w in enumerate(words):
            trie.add(w, i)
        runs = list(trie.runs())
        assert [w for w, _ in runs] == sorted(set(words))
        assert sorted(i for _, ids in runs for i in ids) == list(range(len(words)))


def test_deep_shallow_sort_orders_like_sorted():
    rnd = random.Random(10)
    items = [(bytes(rnd.choice(b"xy") for _ in range(5)), bytes(rnd.choice(b"xyz") for _ in range(4)), i) for i in range(300)]
    got = [(a, b, i) for a, b, ids in suffix_dedup.sorted_runs(items) for i in sorted(ids)]
    assert got == sorted(items)


def test_repeats_of_awkward_rows(spark):
    df = awkward.docs(spark)
    out = suffix_dedup.remove_repeats(df)
    same(out, df)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=key)
    want = [(r[0], None if r[1] is None else w[3].decode("utf-8", "ignore"))
            for r, w in zip(awkward.rows(), brute_bytes([r[1] for r in awkward.rows()], 400))]
    assert got == sorted(want, key=key)
    assert suffix_dedup.remove_repeats(awkward.empty(spark)).count() == 0


# -------------------------------------------------------------------- op 8
def brute_top(rows, is_query, k):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)): v for i, v in ok if is_query(i)}.items():
        scores = sorted(((-int(b @ a), i) for i, b in ok if i != q[0] and len(b) == len(a)))[:k]
        out |= {(q[0], n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("shard,leaf,block", [(8192, 128, 4096), (40, 3, 4)])
def test_top_k_matches_brute_force(spark, shard, leaf, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * rng.choice([0.02, 1])]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(None, [1.0] * 6), (400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6),
             (403, [float("inf")] + [0.0] * 5), (404, []), (410, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = topk.top_k(df, lambda c: c % 10 == 0, query_block=block, shard_rows=shard, leaf_rows=leaf)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, lambda i: i % 10 == 0, 5)


def test_kd_tree_boxes_are_tight_and_prune():
    m = np.random.default_rng(1).integers(-99, 99, (500, 3))
    order, lo, hi, first, last, left = topk.build_tree(m, 16)
    for n in range(len(first)):
        rows = m[order[first[n]:last[n]]]
        assert (rows.min(axis=0) == lo[n]).all() and (rows.max(axis=0) == hi[n]).all()
    leaves = [n for n in range(len(first)) if left[n] < 0]
    assert sorted(i for n in leaves for i in order[first[n]:last[n]]) == list(range(500))
    assert max(last[n] - first[n] for n in leaves) <= 16


def test_top_k_with_few_or_no_rows(spark):
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(one, lambda c: c == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(one, lambda c: c > 9).count() == 0
    assert topk.top_k(one.limit(0), lambda c: c == 0).count() == 0


# -------------------------------------------------------------------- op 1
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(ds):
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(ds[::-1])) % 10 == 0


def brute_spans(t):
    out = {k: [] for k in PLAIN}
    for kind, p in PLAIN.items():
        for m in re.finditer(p, t or ""):
            ds = [int(c) for c in m[0] if c in "0123456789"]
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(ds) <= 19 and luhn(ds), "phone": 8 <= len(ds) <= 15}[kind]
            if ok:
                out[kind].append(m.span())
    return out


def test_base_spans_match_the_plain_patterns():
    rnd = random.Random(21)
    bits = ["a@b.c", "x.y@", "@", "@d.e", "1.2.3.4", "256.1.1.1", "0001.2.3.004", ".", "5", "4111 1111 1111 1111", "4532-",
            "4111111111111111", "+", "+1 (319) 555-5132", "+12", " ", "-", "é", "\n", "(", ")", "%+@h-.i.j", "192.168.0.1", "7"]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans(None) == brute_spans("")


def test_base_spans_of_long_runs_are_fast():
    for t in ("a" * 300_000, "1" * 300_000, "+1" + " " * 300_000, "@" * 100_000, "1." * 100_000, "a@b" * 50_000):
        pii.base_spans(t)


def brute_risky(rows, width=8):
    """Risk of each (entity, term), from the definition."""
    n = len(rows)
    df, ent, pair = collections.Counter(), collections.Counter(), collections.Counter()
    for _, t in rows:
        df.update(set(pii._WORD.findall((t or "").lower())))
        ctx = pii.contexts(t or "", pii.base_spans(t), width)
        ent.update({c[0] for c in ctx})
        pair.update({(c[0], c[1]) for c in ctx if c[1]})
    return {k: np.log(n * c / (df[k[1]] * ent[k[0]])) / np.log(n / ent[k[0]])
            for k, c in pair.items() if c >= pii.MIN_SUPPORT and n > ent[k[0]]}


def test_disclosing_terms_follow_the_corpus(spark):
    rows = [(i, f"note {i}: ask Zorblatt about the plan at eve.moss@mail.example.com today") for i in range(4)]
    rows += [(10 + i, f"the plan of day {i} is to meet today and ask") for i in range(40)]
    rows += [(90, "Zorblatt alone"), (91, None), (92, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, added = pii.disclosures(df)
    risk = brute_risky(rows)
    words = {t for (_, t), r in risk.items() if r >= pii.GENERALISE}
    assert "zorblatt" in words and not words & {"the", "plan", "today", "ask"}
    got = set()
    for r in pii.disclosures(df)[0].join(added, ["_k1", "_k2"]).select("doc_id", "added").collect():
        text = dict(rows)[r.doc_id]
        for s in r.added:
            term = text[s.s:s.f].lower()
            got.add(term)
            e = next(c[0] for c in pii.contexts(text, pii.base_spans(text)) if c[1] == term)
            assert s.kind == ("remove" if risk[e, term] >= pii.REMOVE else "general")
    assert got == words
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "eve.moss" not in out[0] and "Zorblatt" not in out[0] and "<EMAIL>" in out[0] and "plan" in out[0]
    assert out[90] == "Zorblatt alone" and out[91] is None and out[92] == ""


def test_terms_beside_once_seen_entities(spark):
    rows = [(i, f"meet the team Quorvex{'abcdefgh'[i]} at u{i}.x@mail.example.com on monday") for i in range(8)]
    rows += [(10 + i, "meet the team at noon on monday") for i in range(90)]
    rows += [(100, "call Dralthune +1 (319) 555-5132 on monday"), (101, "call the team on monday")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert [out[i] for i in range(8)] == ["meet the team  at <EMAIL> on monday"] * 8
    # "call" stands in two of the 100 documents, "Dralthune" in one.
    assert out[100] == "<TERM>  <PHONE> on monday" and out[101] == rows[-1][1]


def test_sanitise_awkward_rows(spark):
    df = awkward.docs(spark)
    out = pii.sanitise(df)
    same(out, df)
    texts = [r.text for r in out.collect()]
    assert len(texts) == len(awkward.rows()) and texts.count(None) == 2
    assert sum("<EMAIL>" in (t or "") and "<PHONE>" in t for t in texts if t) == 1
    assert pii.sanitise(awkward.empty(spark)).count() == 0


def test_pii_query_columns(spark):
    from tablesync.llm.pii import op1_pii_sanitise

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_pii_sanitise(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = brute_spans(texts[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for k in PLAIN for s, e in b[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(b[k]) for k in PLAIN)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)


def test_held_out_is_crc32(spark):
    from tablesync.llm.quality import held_out

    got = {r.doc_id: r.h for r in spark.range(500).withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out("doc_id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(500)}


# ------------------------------------------------ beyond the bounds there were
def test_context_words_of_any_length_and_distance():
    far, long = "x" * 3000, "y" * 1200
    text = f"{long} {far} bob@a.de {' ' * 5000}near {long}\nnext line word"
    got = {t for _, t, *_ in pii.contexts(text, pii.base_spans(text))}
    assert got == {long, far, "near"}
    line = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} u{chr(97 + i % 26)}@x.de" for i in range(3000))
    rows = pii.contexts(line, pii.base_spans(line))
    assert len({r[0] for r in rows}) == 26 and max(r[3] for r in rows) > len(line) - 60
    # Each word near a span is next to it: as plain brute force over the line says.
    spans = [s for v in pii.base_spans(line).values() for s in v]
    words = [m.span() for m in re.finditer(r"[^\W\d_]{2,}", line)]
    inside = lambda w: any(a < w[1] and w[0] < b for a, b in spans[:40])
    for a, b in spans[5:9]:
        near = [w for w in words if w[1] <= a][-8:] + [w for w in words if w[0] >= b][:8]
        want = sorted(w for w in near if not inside(w))
        assert want == sorted((r[2], r[3]) for r in rows if r[2] >= want[0][0] and r[3] <= want[-1][1]
                              and r[0] == pii._entity("email", line[a:b]) and (r[2], r[3]) in near)


def test_top_k_of_many_blocks_of_queries(spark):
    rnd = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rnd.integers(-9, 9, 5)]) for i in range(60)]
    rows += [(7, [1.0] * 5), (7, [2.0] * 5), (7, [1.0] * 5)]  # one query, three rows, two vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = sorted(tuple(r) for r in topk.top_k(df, lambda c: c < 30).collect())
    many = sorted(tuple(r) for r in topk.top_k(df, lambda c: c < 30, query_block=4).collect())
    assert one == many and len({r[0] for r in one}) == 30


def test_scores_past_64_bits_fail_rather_than_wrap(spark):
    df = spark.createDataFrame([(0, [1e15, 1e15]), (1, [1e15, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(df, lambda c: c == 0).collect()
