"""Prefix trie, recurring phrases and Merkle manifest, against plain brute force."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import conv_trie, merkle, phrase_dedup, ranks

from . import awkward

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_ranks_of_groups_and_nulls(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.randrange(500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x long, i long")
    got = ranks.ranked(df.repartition(13), ["g"], [F.col("x"), F.col("i")], "t").collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {r[2]: (k, len(v)) for v in by.values() for k, r in enumerate(sorted(v, key=lambda r: r[1:]))}
    assert {r.i: (r["_rank"], r["_size"]) for r in got} == want
    alone = ranks.ranked(df.filter("i < 50"), [], [F.col("i").desc()], "t").collect()
    assert {r.i: r["_rank"] for r in alone} == {i: 49 - i for i in range(50)}


# ------------------------------------------------------------------- op 13
def enc(v):
    return b"-" if v is None else b"%d:" % len(str(v).encode()) + str(v).encode()


def climb(hashes):
    """Levels of a tree, from the leaves to the one node at the top."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def brute_manifest(rows):
    def leaf(r):
        return sha(b"".join(enc(v) for v in (r[0], r[3], r[2], r[4], r[1])))

    trees = collections.defaultdict(list)
    for i, r in enumerate(rows):
        trees[r[2]].append(i)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made, tops = {}, []
    for lang in order:
        trees[lang].sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf(rows[i])))
        made[lang] = climb([leaf(rows[i]) for i in trees[lang]])
        tops.append(made[lang][-1][0])
    forest = climb(tops)
    out = []
    for t, lang in enumerate(order):
        for at, i in enumerate(trees[lang]):
            r = rows[i]
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]) if r[1] else r[1]
            third = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h, proof = leaf((r[0], low, *r[2:])) if third else leaf(r), ""
            for levels, k in ((made[lang], at), (forest, t)):
                for nodes in levels[:-1]:
                    run = nodes[k // 8 * 8:k // 8 * 8 + 8]
                    left, right = "".join(run[:k % 8]), "".join(run[k % 8 + 1:])
                    proof, h, k = proof + left + right, sha(left + h + right), k // 8
            out.append((r[0], leaf(r), tops[t], forest[-1][0], sha(proof), h, h == forest[-1][0]))
    return out


def manifest_rows(df):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return [tuple(r) for r in merkle.manifest(df, third).collect()]


def test_manifest_of_awkward_rows(spark):
    rows = awkward.rows()
    got = manifest_rows(awkward.docs(spark))
    assert sorted(got, key=key) == sorted(brute_manifest(rows), key=key)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 513, 700])
def test_manifest_of_every_height(spark, n):
    rnd = random.Random(n)
    rows = [(i, f"Text {i}" if i % 5 else None, rnd.choice(["x", "x", "x", "y"]) if n > 9 else "x", "s", i)
            for i in rnd.sample(range(10 * n), n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(manifest_rows(df), key=key) == sorted(brute_manifest(rows), key=key)


def test_manifest_of_several_tiers_and_many_trees(spark, monkeypatch):
    rows = [(i, "a", f"l{i % 11}" if i % 3 else "big", None, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(df).collect()
    assert all(r.verified for r in got) and len({r.root for r in got}) == 1 and len({r.subroot for r in got}) == 12
    want = {r[0]: r[1:5] for r in brute_manifest(rows)}
    assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256) for r in got} == want


def test_manifest_of_an_empty_table(spark):
    assert merkle.manifest(awkward.empty(spark)).count() == 0


def test_proofs_carry_rows_and_paths(spark):
    df = spark.createDataFrame([(i, sha(str(i)), "t", "extra") for i in range(20)], "i long, leaf string, p string, h string")
    got = merkle.proofs(df, "p", ["i"]).collect()
    assert sorted(r.p.i for r in got) == list(range(20)) and {r.p.h for r in got} == {"extra"}
    assert all(len(r.path) == 2 for r in got)  # eight to a node: two levels, and one tree has no level above


# ------------------------------------------------------------------- op 12
BLANK = " \t\n\x0b\x0c\r"


def brute_phrases(texts, window=35):
    docs = [(t or "").translate({ord(c): " " for c in BLANK}).split(" ") for t in texts]
    docs = [[w for w in d if w] for d in docs]
    starts = collections.Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if starts[tuple(d[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(d), len(gone), sha(" ".join(w for i, w in enumerate(d) if i not in gone))))
    return out


def phrase_rows(df, **options):
    out = phrase_dedup.kept_words(df, **options).select("_row.doc_id", "_r.*").collect()
    return [(r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in out]


def passages(seed, docs=150, words=40):
    """Texts with passages of all lengths around the window, cut, nested and shared by many."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]

    def run(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    shared = [run(rnd.choice([34, 35, 36, 50, 62, 63, 80, 200])) for _ in range(25)] + [["same"] * 60, ["a", "b"] * 40]
    out = []
    for _ in range(docs):
        text = []
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(shared)
            a = rnd.randrange(max(1, len(p) - 30))
            text += run(rnd.randrange(30)) + p[a if rnd.random() < 0.5 else 0:]
        text += run(rnd.randrange(60))
        out.append(rnd.choice([" ", "\n", "\t ", "  "]).join(text) + rnd.choice(["", " \r\n"]))
    return out


@pytest.mark.parametrize("options", [{}, {"crowd": 2, "shard_words": 500}, {"crowd": 1, "grams": (3, 9, 35)}])
def test_phrases_match_brute_force(spark, options):
    texts = passages(7)
    texts += texts[:9] + texts[:1] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = [(i, *r) for i, r in enumerate(brute_phrases(texts))]
    assert sorted(phrase_rows(df, **options)) == want
    assert sum(r[2] > 0 for r in want) > 50 and sum(r[2] == 0 for r in want) > 10


def test_phrases_of_awkward_rows(spark):
    df, rows = awkward.docs(spark), awkward.rows()
    got = phrase_rows(df.select("doc_id", "text", "_k1", "_row", "f"))
    want = [(r[0], *x) for r, x in zip(rows, brute_phrases([r[1] for r in rows]))]
    assert sorted(got, key=key) == sorted(want, key=key)
    out = phrase_dedup.remove_phrases(df)
    assert out.columns == df.columns and out.count() == len(rows)
    kept = {r.doc_id: r.text for r in out.filter("doc_id < 6").collect()}
    assert kept == {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 6}
    assert phrase_dedup.remove_phrases(awkward.empty(spark)).count() == 0


def test_a_passage_of_the_window_goes_and_a_shorter_one_stays(spark):
    p = [f"p{i}" for i in range(35)]
    texts = [" ".join(["x1", *p, "x2"]), " ".join(["y1", *p, "y2"]), " ".join(["z", *p[:34], "z2"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in phrase_dedup.remove_phrases(df).collect()}
    assert got == {0: "x1 x2", 1: "y1 y2", 2: texts[2]}


def test_segments_are_cut_alike_wherever_a_window_stands():
    rnd = random.Random(2)
    known = phrase_dedup._Hashes()
    for gram in phrase_dedup.GRAMS:
        text = [str(rnd.randrange(9)).encode() for _ in range(400)]
        w = np.array([known[x] for x in text], np.uint64)
        m, _, start, n = phrase_dedup.segments(w, 35, gram)
        assert n.sum() == 366 and n.max() <= 35 - gram + 1
        anchor = {int(s) + i: a for a, s, k in zip(m.tolist(), start, n) for i in range(int(k))}
        for i in rnd.sample(range(366), 40):
            assert phrase_dedup.segments(w[i:i + 35], 35, gram)[0].tolist() == [anchor[i]]


# ------------------------------------------------------------------- op 11
def brute_trie(rows, text_words=lambda t: len([w for w in t.translate({ord(c): " " for c in BLANK}).split(" ") if w])):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    original = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(original.get(c - c % 20, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * text_words(p[-1][1]) if p else 0
        sums[p] = (sum(sums[k][0] for k in kids[p]) or 1, own + sum(sums[k][1] for k in kids[p]))
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *sums[p],
             sha(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)))) for p, m in members.items()]


CONV = "conv_id long, turn long, role string, text string"


def trie_rows(df, **options):
    return sorted((tuple(r) for r in conv_trie.prefix_trie(df, **options).collect()), key=key)


def made_up(seed, convs=120):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(600), convs):
        for t in range(rnd.choice([1, 2, 3, 4, 5, 9])):
            rows.append((c, t, rnd.choice(["user", "user", "assistant", None]), rnd.choice(["hi", "hi there you", "", None])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("local", [8192, 20, 3])
def test_trie_matches_brute_force(spark, local):
    rows = made_up(3)
    df = spark.createDataFrame(rows, CONV).repartition(4)
    assert trie_rows(df, local=local) == sorted(brute_trie(rows), key=key)


def test_trie_of_awkward_rows(spark):
    rows = [(20, None, "user", "null first"), (20, 0, None, None), (20, 0, "user", "b"), (20, 0, "user", "a"),
            (21, 1, "x", " \n"), (21, 1, "x", " \n"), (41, 0, "u", "no base: too short"), (None, 0, "u", "t"),
            (-7, 0, "u", "neg"), (0, 0, "u", "é " * 4000), (1, -5, "u", "é " * 4000), (2, 0, "", "")]
    wide = spark.createDataFrame([(*r, "k", 7, "d") for r in rows], CONV + ", conv string, d long, g1 string")
    # SQL's remainder: -7 - (-7 % 20) is 0.
    want = brute_trie([r for r in rows if r[0] != -7])
    got = trie_rows(wide.filter("conv_id IS NULL OR conv_id <> -7"))
    assert got == sorted(want, key=key)
    assert len(trie_rows(wide)) >= len(got)
    assert conv_trie.prefix_trie(wide.limit(0)).count() == 0


@pytest.mark.parametrize("local", [8192, 40])
def test_trie_of_a_long_and_a_common_conversation(spark, local, monkeypatch):
    monkeypatch.setattr(conv_trie, "BLOCK", 7)
    rows = [(40, t, "u", f"word {t}") for t in range(400)] + [(45, t, "u", f"word {t}") for t in range(380)]
    rows += [(60 + c, t, "u", f"same {t}") for c in range(60) for t in range(3)]
    df = spark.createDataFrame(rows, CONV).repartition(3)
    assert trie_rows(df, local=local) == sorted(brute_trie(rows), key=key)


def test_decomposition_equals_plain_sums():
    rnd = random.Random(4)
    for shape in ("chain", "star", "random"):
        n = 300
        parent = [-1] + [{"chain": i - 1, "star": 0, "random": rnd.randrange(i)}[shape] for i in range(1, n)]
        values, added = [[rnd.randrange(9), 1] for _ in range(n)], [[rnd.randrange(3), 0] for _ in range(n)]
        want = [list(v) for v in values]
        for i in range(n - 1, 0, -1):
            want[parent[i]] = [a + b for a, b in zip(want[parent[i]], want[i])]
        want = [[a + b for a, b in zip(w, x)] for w, x in zip(want, added)]
        assert conv_trie.decompose(parent, values, added) == want


# ---------------------------------------------------------------- their SQL
@pytest.mark.parametrize("module, query, table", [
    (conv_trie, "op11_prefix_trie", "conversations"), (phrase_dedup, "op12_phrase_dedup", "documents"),
    (merkle, "op13_merkle_manifest", "documents")])
def test_queries_equal_their_sql(spark, module, query, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(getattr(module, query.split("_")[0].upper() + "_SQL"))
    got = getattr(module, query)(spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    names = sorted(got.columns)
    rows = [tuple(r[names.index(c)] for c in names) for r in want.select(*names).fetchall()]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(rows, key=key) and rows
