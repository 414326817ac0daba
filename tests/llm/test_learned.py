"""Operators that learn or draw: near-duplicates, quality, language, HTML, and
the pipeline."""

import collections
import itertools
import random
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import html_text, language, neardup, quality

from . import awkward
from .test_exact import same

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------- op 10
def exact_classes(texts, sampler, threshold=0.8):
    """Components of exact weighted similarity, over all pairs."""
    packed = {}
    for i, t in texts.items():
        h, tf = neardup.shingles(neardup.words(t))
        if len(h):
            packed[i] = neardup._packed(h, sampler.weights(h, tf)[1])
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = []
    for a, b in itertools.combinations(sorted(packed), 2):
        if neardup.weighted_jaccard(packed[a], packed[b]) >= threshold:
            links.append((a, b))
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in texts}, links


def near_copies(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([8, 60, 200]))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 40))):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "one two", "one two", "one two three"]
    return dict(enumerate(texts))


def test_near_duplicates_match_all_pairs(spark):
    texts = near_copies()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, links = exact_classes(texts, neardup.fit_sampler(df))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert got == want and len(links) > 30
    sizes = collections.Counter(got.values())
    assert {r.doc_id: r.class_size for r in neardup.near_duplicates(df).collect()} == {i: sizes[c] for i, c in got.items()}
    kept = neardup.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_in_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect() if len(r.text) < 6000}
    docs = docs.where(F.length("text") < 6000)
    want, links = exact_classes(texts, neardup.fit_sampler(docs))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert len(links) > 50 and got == want


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(3)
    agree, exact = [], []
    for _ in range(150):
        both = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        sampler = neardup.Sampler(both[::2], np.arange(150) % neardup.IDF_LEVELS)
        parts = [np.sort(np.concatenate([both[:240], rng.integers(0, 1 << 63, 40).astype(np.uint64)])) for _ in range(2)]
        tf = [rng.integers(1, 4, len(p)) for p in parts]
        tf[1] = np.array([dict(zip(parts[0].tolist(), tf[0].tolist())).get(h, 1) for h in parts[1].tolist()])
        x, y = (sampler.signature(p, t) for p, t in zip(parts, tf))
        agree.append((x == y).mean())
        exact.append(neardup.weighted_jaccard(*(neardup._packed(p, sampler.weights(p, t)[1]) for p, t in zip(parts, tf))))
    assert abs(np.mean(agree) - np.mean(exact)) < 0.02


def test_document_frequencies_are_exact(spark, monkeypatch):
    """Every shingle in one of RARE documents has the level of its own count,
    whatever shares its place and however often a text repeats it."""
    monkeypatch.setattr(neardup, "HELD", 500)
    rnd = random.Random(8)
    held = [f"{a} b c d e" for a in "uvwxyz"]
    texts = []
    for i in range(900):
        own = " ".join(f"q{i}x{j}" for j in range(rnd.randrange(5, 40)))
        shared = [h for k, h in enumerate(held) if i % (3 ** k) == 0]
        texts.append(" ".join(f"{h} {h} s{i}k{k}" for k, h in enumerate(shared)) + " " + own)
    texts += [None, "", "..."]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    sampler = neardup.fit_sampler(df)
    counts = collections.Counter()
    for t in texts:
        counts.update(neardup.shingles(neardup.words(t))[0].tolist())
    n = sum(bool(neardup.words(t)) for t in texts)
    want = {h: round(min(1, np.log(n / c) / np.log(neardup.RARE)) * (neardup.IDF_LEVELS - 1))
            for h, c in counts.items() if c * neardup.RARE >= n}
    assert dict(zip(sampler.frequent.tolist(), sampler.levels.tolist())) == want
    assert len(want) > 5 and len(set(want.values())) > 3
    h = np.array(sorted(counts), np.uint64)
    level, _ = sampler.weights(h, np.ones(len(h)))
    assert level.tolist() == [want.get(x, neardup.IDF_LEVELS - 1) for x in h.tolist()]


def test_texts_hashed_together_keep_their_own_shingles(monkeypatch):
    monkeypatch.setattr(neardup, "RUN", 40)
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.choice([0, 1, 2, 4, 5, 6, 30, 90]))) for _ in range(200)]
    out = list(neardup.runs([None, *texts, "é ß", "!"]))
    assert [found for found, _ in out] == [neardup.words(t) for t in (None, *texts, "é ß", "!")]
    assert all(h.tolist() == neardup.running(found).tolist() for found, h in out)
    ids = {}
    for found, h in out:
        grams = [tuple(found[i:i + 5]) for i in range(max(len(found) - 4, min(len(found), 1)))]
        assert len(grams) == len(h) and all(ids.setdefault(g, x) == x for g, x in zip(grams, h.tolist()))
    assert len(set(ids.values())) == len(ids)


def test_no_pair_that_reaches_the_threshold_is_left_unverified():
    rng = np.random.default_rng(5)
    left = near = 0
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        keep = rng.random()
        h = rng.integers(0, 1 << 63, (3, n)).astype(np.uint64)
        k = int(n * keep)
        sets = [np.unique(np.concatenate([h[0, :k], x[:n - k]])) for x in h[1:]]
        weights = [rng.choice([1.0, 1.1, 2.7], len(x)).astype(np.float32) for x in sets]
        same_ = dict(zip(sets[0].tolist(), weights[0].tolist()))
        weights[1] = np.array([same_.get(x, w) for x, w in zip(sets[1].tolist(), weights[1])], np.float32)
        exact = neardup.weighted_jaccard(*(neardup._packed(x, w) for x, w in zip(sets, weights)))
        reach = neardup.within_reach(*(neardup.binned(x, w)[None] for x, w in zip(sets, weights)), 0.8)[0]
        assert reach or exact < 0.8
        near += exact >= 0.8
        left += not reach
    assert near > 200 and left > 1000


def test_near_duplicates_of_awkward_rows(spark):
    df = awkward.docs(spark)
    out = neardup.near_duplicates(df).collect()
    assert len(out) == len(awkward.rows())
    by = collections.Counter((r.doc_id, r.class_id, r.class_size) for r in out)
    assert by[(9, 9, 3)] == 3 and by[(6, 6, 2)] == 2 and by[(0, 0, 1)] == 1 and by[(4, 4, 1)] == 1
    kept = neardup.keep_one(df)
    same(kept, df)
    texts = [r[1] for r in awkward.rows()]
    want, _ = exact_classes({i: t for i, t in enumerate(texts) if neardup.words(t)}, neardup.fit_sampler(df))
    assert kept.count() == len(set(want.values())) + sum(not neardup.words(t) for t in texts)
    assert neardup.near_duplicates(awkward.empty(spark)).count() == 0
    assert neardup.keep_one(awkward.empty(spark)).count() == 0


def test_a_chain_of_links_is_one_class(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([f"x{j}" for j in range(6 * i)] + base[6 * i:])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = exact_classes(dict(rows), neardup.fit_sampler(df))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert got == want and len(set(got.values())) == 1


# -------------------------------------------------------------------- op 3
def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    emit, trans = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    good, moves = quality.marginals(np.where(mask, emit, 0.0), mask, trans)
    for d in range(3):
        n = mask[d].sum()
        p, m, z = np.zeros(n), np.zeros((2, 2)), 0.0
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(emit[d, i] * y[i] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            z += s
            p += s * np.array(y)
            for a, b in zip(y, y[1:]):
                m[a, b] += s
        assert np.allclose(good[d, :n], p / z) and np.allclose(moves[d], m / z)


def test_quality_holds_on_held_out_documents(spark):
    out = quality.op3_quality_crf(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    m = out.merge(labels, on="doc_id")
    m = m[m.held_out]
    assert len(out) == 10_000 and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    assert (m.predicted == m.quality).mean() > 0.97
    assert m[m.quality == 1].predicted.mean() > 0.99 and m[m.quality == 0].predicted.mean() < 0.15


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x, steps=20) for x in (labels, flipped))
    assert np.array_equal(a.w, b.w) and (a.a, a.b) == (b.a, b.b)


def test_quality_of_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), steps=20)
    df = awkward.docs(spark)
    out = quality.score(df, model)
    assert out.columns == [*df.columns, "score"] and out.where("score between 0 and 1").count() == df.count()
    by = collections.defaultdict(set)
    for r in out.collect():
        by[r.text].add(r.score)
    assert all(len(v) == 1 for v in by.values())  # equal texts, equal scores
    assert quality.score(awkward.empty(spark), model).count() == 0
    untrained = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet").limit(0))
    assert quality.score(df, untrained).where("score between 0 and 1").count() == df.count()


# -------------------------------------------------------------------- op 9
def test_language_of_pages(spark):
    out = language.op9_language_id(spark, SF).toPandas()
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    assert len(out) == len(pages) and (out.language == out.declared).mean() > 0.97
    assert out.posterior.between(0, 1).all()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.fit(docs.where("doc_id % 5 > 0"))
    rows = docs.where("doc_id % 5 = 0 and length(text) > 60").select("text", "lang").collect()
    right = [model.languages[int(np.argmax(model.posterior(r.text)[1]))] == r.lang for r in rows]
    assert np.mean(right) > 0.98


def test_evidence_is_weighed():
    n = np.array([50, 50, 0])
    p = np.array([[0.5, 0.5], [0.5, 0.5], [0.5, 0.5]])
    whole = np.array([1000.0, 1000.0])
    nan = np.full((3, 2), np.nan)
    host = np.array([[90.0, 10.0], [np.nan, np.nan], [0.0, 40.0]])
    best, name = language.posteriors(n, p, whole, nan, nan, host, nan)
    assert list(name) == [0, 0, 1] and best[0] > 0.7 and best[1] == pytest.approx(0.5) and best[2] > 0.7
    declared = np.array([[900.0, 5.0], [5.0, 900.0], [np.nan, np.nan]])
    best, name = language.posteriors(n, p, whole, declared, nan, nan, nan)
    assert list(name[:2]) == [0, 1] and (best[:2] > 0.95).all()


def test_language_keeps_clean_documents_and_drops_letterless_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    kept = language.keep_identified(docs, model)
    same(kept, docs)
    assert kept.count() == docs.count()
    df = awkward.docs(spark)
    texts = [r.text for r in language.keep_identified(df, model).collect()]
    assert not {None, "", "   ", "\n\n", "!!! ???"} & set(texts) and sum(awkward.LINE in t for t in texts) >= 6
    assert language.keep_identified(awkward.empty(spark), model).count() == 0
    nothing = language.fit(awkward.empty(spark))
    assert language.keep_identified(df, nothing).count() == 0  # no language is known
    pages = spark.createDataFrame([(None, None, None), (1, "", "x"), (2, "<p>", "http://h"), (2, "<p>", "http://h")],
                                  "page_id long, html string, url string")
    assert [r.language for r in language.identify_pages(pages, model).collect()] == ["und"] * 4


def foreign():
    rnd = random.Random(4)
    letters = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9))) for _ in range(90))
    return {
        "letters": letters,
        "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и "
              "должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь и свободу.",
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
              "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Kullakin yksilöllä on oikeus elämään.",
        "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、"
              "互いに同胞の精神をもって行動しなければならない。すべて人は、生命、自由及び身体の安全に対する権利を有する。"}


def test_what_no_label_is_like_is_unknown(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    junk = spark.createDataFrame([(-1 - i, t, "es", "src1", len(t)) for i, t in enumerate(foreign().values())], docs.schema)
    kept = language.keep_identified(docs.unionByName(junk), model)
    assert kept.count() == docs.count() and kept.where("doc_id < 0").count() == 0
    # A language the labels lack, out of the given documents themselves.
    rows = {r.page_id: r.language for r in language.identify_pages(
        docs.where("lang = 'fr' and length(text) > 400").select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"),
                                                                F.lit(None).cast("string").alias("url")),
        language.fit(docs.where("lang != 'fr'"))).collect()}
    assert len(rows) > 50 and np.mean([x == "und" for x in rows.values()]) > 0.95


@pytest.mark.parametrize("html,declared", [
    ("<!-- " + "licence " * 2_000 + "-->\n<html lang=de><p>x", "de"),
    ("\n" * 5_000 + "<!doctype html><html class='a' lang='FR-ca'>x", "fr"),
    ("<?xml version='1.0'?><html xml:lang=\"es\">x", "es"),
    ("<!-- <html lang=en> --><html lang=de>x", "de"), ("<html lang=de>x<html lang=en>", "de"),
    ("<html data-lang=de>x<p>&lt;html lang=fr>", None), ("", None), (None, None),
])
def test_declared_language_anywhere_in_the_page(html, declared):
    assert language.page_evidence(html, None)[1] == declared


def test_every_label_is_a_language(spark):
    rnd = random.Random(9)
    rows = []
    for k in range(90):  # a label's words are made of syllables of its own
        parts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
        for _ in range(4 if k < 70 else 3):
            text = " ".join(rnd.choice(parts) + rnd.choice(parts) for _ in range(150))
            rows.append((len(rows), text, f"l{k:02}", f"s{k % 5}", len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.fit(docs)
    assert model.languages == [f"l{k:02}" for k in range(90)] + ["und"]
    assert [model.languages[int(np.argmax(model.posterior(r[1])[1]))] for r in rows] == [r[2] for r in rows]
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.lit("http://h.x/").alias("url"))
    got = {r.page_id: r.language for r in language.identify_pages(pages, model).collect()}
    assert got == {r[0]: r[2] for r in rows}
    assert language.keep_identified(docs, model).count() == len(rows)


def test_whole_texts_are_learned_from(spark):
    """Letters that come after 20 000 characters count, too."""
    rows = [(i, "na ba " * 4000 + f"zo{'qx' * 30} " * 400, "aa") for i in range(3)]
    rows += [(10 + i, "mi ki " * 4000, "bb") for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages[int(np.argmax(model.posterior("zoqxqxqxqx qxqxqxqx qxqxqxqxqx")[1]))] == "aa"


def test_quality_of_texts_of_many_lines(monkeypatch):
    rnd = np.random.default_rng(3)
    model = quality.Model()
    model.w, model.trans = rnd.normal(size=quality.N_FEATURES), rnd.normal(size=(2, 2))
    text = "\n".join(["A plain line of words.", "### $$$", "", "| a | b |", "MORE THAN ENOUGH!!"] * 900)
    whole = model.emissions(text)
    f, n = quality.document_features(text)
    assert np.allclose(whole[0], f @ model.w) and (whole[1] == n).all()
    want = model.scores([text, "", None, "one line"])
    monkeypatch.setattr(quality, "BATCH_LINES", 7)  # blocks of lines meet without a seam
    assert np.allclose(model.scores([text, "", None, "one line"]), want)


# -------------------------------------------------------------------- op 2
@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"),
    ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
    ("<title>t</title><body><h1>Head</h1>a  b\n c<div>d</div>e", "Head\n\na b c\nd\ne"),
    ("<script>var x='<p>no</p>'</script><style>p{}</style>x<!-- y --><template>n</template>", "x"),
    ("<div hidden>a</div><p style='display : none'>b<p>c", "c"),
    ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span></div>", "b"),
    ("<ul><li>a<li>b<ol start=3><li>x<li value=7>y<li>z</ol></ul>c", "- a\n- b\n  3. x\n  7. y\n  8. z\n\nc"),
    ("<table><tr><th>k<th>value<tr><td>long key<td>1</table>", "k         value\nlong key  1"),
    ("<table><tr><td colspan=2>wide<td>r<tr><td>a<td>b<td>c</table>", "wide  r\na  b  c"),
    ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x  1\n   2"),
    ("<table><tfoot><tr><td>foot</tfoot><tr><td>body<table><tr><td>in</table></table>", "body\n\nin\nfoot"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"),
    ("&lt;b&gt; &amp; caf&eacute; &#x41;", "<b> & café A"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<p>a</b></i>b</p></div>c", "ab\n\nc"),
    ("<a title='x>y'>link</a> <b", "link <b"),
    ("<select><option>1<option>2</select><textarea>t <b></textarea>", "1\n2\nt <b>"),
])
def test_rendering(html, text):
    assert html_text.visible_text(html) == text


@pytest.mark.parametrize("html,text", [
    ('<div class="x"">Text one</div><div class="x"">Text two</div>', "Text one\nText two"),
    ("<p title=don't>Visible text, it's here</p>", "Visible text, it's here"),
    ("<p 'a>one</p><p b'>two</p>", "one\n\ntwo"),
    ("<a href=/x/?q=\"1\">link</a> it's", "link it's"),
    ("<p title = 'a>b' hidden>no<p title= >yes</p x='>'>", "yes"),
    ("<p>a <svg><defs><text>d</text></defs><title>t</title><path d='M0'/><g><text>Sales</text><text>2 <tspan>kg</tspan>"
     "</text></g></svg> b", "a Sales 2 kg b"),
    ("<svg viewBox='0'/>after<p>next", "after\n\nnext"),
    ("<svg><path d=M0><p>out of it", "out of it"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"),
    ("so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math>.",
     "so x=1."),
])
def test_stray_quotes_images_and_formulas(html, text):
    assert html_text.visible_text(html) == text


@pytest.mark.parametrize("html,text", [
    ("<style>.h{display:none}</style><p class=h>gone<p class='x h'>gone<p>kept", "kept"),
    ("<style>p > b, #i .z{visibility:hidden}</style><p>a<b>no</b><i><b>yes</b></i><div id=i><i><u class='a z'>no</u></i></div>", "ayes"),
    ("<style>@media print{p{display:none}} @media screen, tv{b{display:none}}</style><p>x<b>y</b>", "x"),
    ("<style>@media (max-width:9px){p{display:none}} /* i{display:none} */ @import 'x'; em{display : none}</style><p>x<i>y</i><em>z", "xy"),
    ("<style>p{display:none!important}</style><p style='display:block'>x</p>y", "y"),
    ("<style>.a{display:none} p.a{display:block}</style><p class=a>shown<div class=a>hid", "shown"),
    ("<style>#q{display:none}.c{display:block}</style><i id=q class=c>x</i><b hidden class=c>y</b>", "y"),
    ("<style media=print>p{display:none}</style><style>p:hover{display:none} p[x]{display:none}</style><p x>y", "y"),
    ("<body><p>a</p><style>p{display:none}", ""), ("<p style='color:red;display:none'>x</p>y", "y"),
    ("<object data=x><p>fallback</object>", "fallback"), ("a</>b</ c>d <3 x", "abd <3 x"),
    ("<a b='x> <p>para</p> it's", "para\n\nit's"),
])
def test_style_sheets_fallbacks_and_broken_tags(html, text):
    assert html_text.visible_text(html) == text


@pytest.mark.parametrize("unit", [
    '<a b="', "<a b ", "</a b ", "<a b='>' ", "<title></title ", "<!-- ", '<a b="x> ', "<!", "</", '<a "', "<x y='", "&lt",
    "<style>.a{display:none}</style><p class=a>x", "<style>.a .b{display:none}", "<b>x</b>", "<textarea>"])
def test_time_grows_with_the_page_only(unit):
    import time

    took = []
    for n in (250_000, 1_000_000):
        page = unit * (n // len(unit))
        start = time.process_time()
        html_text.visible_text(page)
        took.append(time.process_time() - start)
    # Four times the page: four times the time, or so little that it cannot be told.
    assert took[1] < max(0.5, 9 * took[0])
    if ">" not in unit:
        assert took[1] < 1.0


class Shown(HTMLParser):
    """Words of a page by another parser and a plain rule: not those inside
    elements that never show or are hidden."""

    NEVER = {"script", "style", "template", "title", "noscript", "head", "svg", "iframe"}
    EMPTY = {"br", "img", "meta", "link", "input", "hr", "base", "col", "wbr", "source", "area", "param"}

    def __init__(self):
        super().__init__()
        self.words, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in self.EMPTY:
            said = dict(attrs)
            style = (said.get("style") or "").replace(" ", "").lower()
            self.open.append((tag, tag in self.NEVER or "hidden" in said or "display:none" in style))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(hidden for _, hidden in self.open):
            self.words += data.split()


def test_words_of_the_given_pages_by_another_parser(spark):
    rows = html_text.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    differ = []
    for r in rows:
        other = Shown()
        other.feed(r.html)
        other.close()
        want = collections.Counter("".join(other.words))
        got = collections.Counter(re.sub(r"(?m)^(?: *(?:- |[0-9]+[.] ))+", "", r.text).replace(" ", "").replace("\n", ""))
        differ += [(r.page_id, want - got, got - want)] if sum(((want - got) + (got - want)).values()) else []
    assert len(rows) == 250 and not differ


def all_text(node, seen=True):
    """Visible words of a tree, in order, without any layout."""
    if isinstance(node, str):
        return node.split() if seen else []
    return [w for c in node.children if isinstance(c, str) or not html_text._hidden(c)
            for w in all_text(c, seen and html_text._shown(node, seen))]


def test_no_visible_word_is_lost(spark):
    out = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    for r in out:
        want = collections.Counter("".join(all_text(html_text.parse(r.html))))
        got = collections.Counter(r.text.replace("- ", "").replace(" ", "").replace("\n", ""))
        want.pop("-", None), got.pop("-", None)
        assert got == want
        assert "track(" not in r.text and "margin:0" not in r.text and "charset" not in r.text


def test_deep_and_long_pages_do_not_break(spark):
    deep = "<div>" * 50_000 + "core" + "</div>" * 50_000
    lists = "<ul><li>" * 3_000 + "leaf"
    pages = spark.createDataFrame([(1, deep, "a"), (2, lists, None), (3, "<p>x" * 50_000, ""), (None, None, None)],
                                  "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[1] == "core" and got[2].endswith("leaf") and got[3].count("x") == 50_000 and got[None] == ""
    assert html_text.extract(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.count()
    counts = []
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        same(docs, before)
        counts.append(docs.count())
    assert counts[0] == first and counts[1] == first and counts[2] < counts[1] and counts[3] < counts[2]
    out = cp.run(spark, SF)
    assert out.count() == counts[3] and {"doc_id", "size", "target", "taken"} <= set(out.columns)
    lines = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        lines.update({x.strip().lower() for x in r.text.split("\n") if len(x.strip()) >= 40})
    assert max(lines.values()) < 5


def test_pipeline_over_awkward_rows(spark):
    import corpus_pipeline as cp

    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = real.unionByName(awkward.docs(spark).select(*real.columns))
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0
    empty = real.limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
