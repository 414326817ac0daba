"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its key is a pair of running
sums of turn hashes (104 bits), so all conversations find their nodes by
themselves and members are counted by a combining sum.  What a subtree holds
(leaves, saved tokens) is then added up over the parent-edge forest:

* The centroid of a component is its lowest node with at least half of the
  component below it.  Removing it leaves the subtrees of its children and the
  part above.
* The totals of the components below the centroid, with its own value, are the
  centroid's sum.  That sum is added to every node on the path from the
  centroid to the component's top, and the parts go on by themselves: each
  holds at most half of the component, whatever the shape of the tree.

Components of up to ``LOCAL`` nodes are finished inside a task, one after the
other.  Larger ones are split by Spark, all of them at once each round: nodes
below a centroid are those whose conversation passes through it, its path is
the centroid's own conversation.  A chain, a star or a first turn that a third
of all conversations share is halved like any other.

No conversation, node or component is collected whole: turns are numbered by
range partitions, running sums go by blocks of ``BLOCK`` turns, and the ends of
a node are hashed as a sorted stream.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm import common
from tablesync.llm.ranks import ranked

FAMILY = 20             # conversations that share a head
HEADS = 4               # a head has up to HEADS - 1 turns
BLOCK = 1000            # turns of a conversation that one window holds
LOCAL = 8192            # nodes of a component that a task finishes
WORD = r"[^\x20\x09-\x0D]+"
_MASK = (1 << 52) - 1   # sums of BLOCK such numbers fit a long


# ------------------------------------------------------------------ the turns
def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``conv, d, s1, s2, words`` of the turns of rebuilt conversations (``d``
    from 1) and ``conv, len`` of all conversations, those without turns too.

    A conversation ``c`` takes the first ``crc32(c) % heads`` turns of
    conversation ``c - c % family`` and its own ones after as many.
    """
    role, text = (F.coalesce(common.quoted(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    flat = turns.filter(common.quoted(conv_col).isNotNull()).select(
        common.quoted(conv_col).cast("long").alias("conv"), common.quoted(turn_col).alias("turn"), role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("text_hash"), F.xxhash64(role, text).alias("s1"),
        F.xxhash64(F.lit(1), text, role).alias("s2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_hash")]
    own = common.saved(ranked(flat, ["conv"], order, "trie-sorted").select(
        "conv", (F.col("_rank") + 1).alias("r"), "s1", "s2", "words", F.col("_size").alias("size")), "trie-turns")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = own.filter("r = 1").select("conv", "size", head.cast("long").alias("h"),
                                       (F.col("conv") - F.col("conv") % family).alias("base"))
    sizes = convs.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("h", F.coalesce("base_size", F.lit(0)))
    convs = convs.join(sizes, "base", "left").select("conv", "base", "h", "size", taken.alias("taken"))
    convs = common.saved(convs, "trie-conversations")
    length = F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    late = own.join(convs.select("conv", "h", "taken"), "conv").filter("r > h").select(
        "conv", (F.col("r") - F.col("h") + F.col("taken")).alias("d"), "s1", "s2", "words")
    early = own.filter(F.col("r") < heads).withColumnRenamed("conv", "base").join(
        convs.select("conv", "base", "taken"), "base").filter("r <= taken").select(
        "conv", F.col("r").alias("d"), "s1", "s2", "words")
    return late.unionByName(early), convs.select("conv", length.alias("len"))


def _masked(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_MASK))


def _running(rows: DataFrame, at: str) -> DataFrame:
    """``g1, g2``: running sums (of 52 bits) of ``e1, e2`` along ``conv``, by
    ``at`` from 1 on without gaps."""
    block = F.floor((F.col(at) - 1) / F.lit(BLOCK)).cast("long")
    rows = rows.withColumn("_b", block)
    upto = Window.partitionBy("conv", "_b").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", *[_masked(F.sum(f"e{i}").over(upto)).alias(f"g{i}") for i in (1, 2)])
    if (rows.agg(F.max("_b")).first()[0] or 0) > 0:
        # Blocks' own sums run on the same way, and each starts from the one before.
        sums = rows.groupBy("conv", (F.col("_b") + 1).alias("_at")).agg(
            *[_masked(F.sum(f"e{i}")).alias(f"e{i}") for i in (1, 2)])
        sums = common.saved(_running(sums, "_at"), "trie-blocks")
        carry = sums.select("conv", F.col("_at").alias("_b"), F.col("g1").alias("_c1"), F.col("g2").alias("_c2"))
        rows = rows.join(carry, ["conv", "_b"], "left").select(
            *[c for c in rows.columns if c not in ("g1", "g2")],
            *[_masked(F.col(f"g{i}") + F.coalesce(f"_c{i}", F.lit(0))).alias(f"g{i}") for i in (1, 2)])
    return rows.drop("_b")


def steps(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv, d, g1, g2, p1, p2, words``: every conversation's nodes from the
    root (``d`` 0) down, with the node above."""
    number = [F.shiftrightunsigned(F.xxhash64("s1", "s2", "d", F.lit(i)), 12) for i in (1, 2)]
    rows = _running(turns.select("conv", "d", "words", *[n.alias(f"e{i + 1}") for i, n in enumerate(number)]), "d")
    rows = rows.select("conv", "d", "g1", "g2", *[
        F.when(F.col("d") > 1, _masked(F.col(f"g{i}") - F.col(f"e{i}") + F.lit(_MASK + 1))).otherwise(F.lit(0))
        .cast("long").alias(f"p{i}") for i in (1, 2)], "words")
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = convs.select("conv", zero.alias("d"), zero.alias("g1"), zero.alias("g2"), none.alias("p1"),
                        none.alias("p2"), zero.alias("words"))
    return root.unionByName(rows)


# ------------------------------------------------------------- centroid rollup
def decompose(parent: list[int], values: list[list[int]], added: list[list[int]]) -> list[list[int]]:
    """Subtree sums of one component's nodes, listed from the top down
    (``parent``: their parents' places, -1 for the top), plus ``added``: split
    at the centroid again and again."""
    out = [list(a) for a in added]
    wide = range(len(values[0])) if values else ()
    work = [list(range(len(parent)))]
    mark = [-1] * len(parent)
    size = [0] * len(parent)
    below: list = [None] * len(parent)
    while work:
        part = work.pop()
        for v in part:
            size[v], below[v] = 1, list(values[v])
        for v in reversed(part[1:]):
            p = parent[v]
            size[p] += size[v]
            for k in wide:
                below[p][k] += below[v][k]
        c = part[0]
        for v in part:                  # from the top down: the last with half below it
            if 2 * size[v] >= len(part):
                c = v
        total = below[c]
        for k in wide:
            out[c][k] += total[k]
        v = c
        while v != part[0]:             # the path from the centroid to the top
            v = parent[v]
            for k in wide:
                out[v][k] += total[k]
        pieces: dict[int, list[int]] = {}
        for v in part:
            if v == c:
                mark[v] = -1
                continue
            p = parent[v]
            mark[v] = v if v == part[0] or p == c else mark[p]
            pieces.setdefault(mark[v], []).append(v)
        work.extend(pieces.values())
    return out


_TREE = ["d", "g1", "g2", "p1", "p2"]


def _finish(batches, names: list[str]):
    """Rows sorted by component and depth: each component rolled up."""
    key, rows = None, []

    def done():
        at = {(r[0], r[1], r[2]): i for i, r in enumerate(rows)}
        parent = [at.get((r[0] - 1, r[3], r[4]), -1) if i else -1 for i, r in enumerate(rows)]
        k = len(names)
        sums = decompose(parent, [r[5:5 + k] for r in rows], [r[5 + k:5 + 2 * k] for r in rows])
        return [(*r[:3], *s) for r, s in zip(rows, sums)]

    columns = ["c1", "c2", "cd", *_TREE, *names, *[f"add_{n}" for n in names]]
    for pdf in batches:
        out = []
        for row in pdf[columns].astype(object).itertuples(index=False, name=None):
            if row[:3] != key:
                if rows:
                    out += done()
                key, rows = row[:3], []
            rows.append(row[3:])
        if out:
            yield pd.DataFrame(out, columns=["d", "g1", "g2", *names])
    if rows:
        yield pd.DataFrame(done(), columns=["d", "g1", "g2", *names])


def rollup(nodes: DataFrame, path: DataFrame, names: list[str], local: int = LOCAL) -> DataFrame:
    """``d, g1, g2`` and the subtree sums of the long columns ``names``.

    ``nodes`` has ``d, g1, g2, p1, p2, conv`` (a conversation through the node)
    and ``names``; ``path`` the steps of all conversations.
    """
    zero = F.lit(0).cast("long")
    tree = nodes.select(*_TREE, "conv", *names, *[zero.alias(f"add_{n}") for n in names],
                        zero.alias("c1"), zero.alias("c2"), zero.alias("cd"))
    settled, results = [], []
    total = nodes.count()
    if total <= local:
        settled.append(tree)
        big = None
    else:
        # A conversation adds the nodes it stands for to every node above them.
        owned = nodes.groupBy("conv").agg(F.min("d").alias("_a"), F.max("d").alias("_z"))
        under = path.join(owned, "conv").select("d", "g1", "g2", (
            F.col("_z") - F.greatest("_a", "d") + 1).alias("size")).filter("size > 0")
        sizes = under.groupBy("d", "g1", "g2").agg(F.sum("size").alias("size"))
        big = common.saved(tree.join(sizes, ["d", "g1", "g2"]), "trie-nodes")
    comp = ["c1", "c2", "cd"]
    while big is not None:
        whole = big.groupBy(*comp).agg(F.max("size").alias("whole"))
        best = (big.join(whole, comp).filter(F.col("size") * 2 >= F.col("whole")).groupBy(*comp)
                .agg(F.min_by(F.struct("d", "g1", "g2", "conv", "size"), "size").alias("x")))
        best = common.saved(best.select(*comp, F.col("x.d").alias("xd"), F.col("x.g1").alias("x1"),
                                        F.col("x.g2").alias("x2"), F.col("x.conv").alias("xc"),
                                        F.col("x.size").alias("xsize")), "trie-centroids")
        # Conversations that go on below a centroid, and by which child.
        through = (path.filter("d > 0").withColumnsRenamed({"p1": "x1", "p2": "x2"})
                   .withColumn("xd", F.col("d") - 1).join(best.select(*comp, "xd", "x1", "x2"), ["xd", "x1", "x2"])
                   .select(*comp, "conv", F.col("g1").alias("n1"), F.col("g2").alias("n2"), F.col("d").alias("nd")))
        split = big.join(through, [*comp, "conv"], "left").join(best, comp)
        below = F.col("nd").isNotNull() & (F.col("d") >= F.col("nd"))
        centre = (F.col("d") == F.col("xd")) & (F.col("g1") == F.col("x1")) & (F.col("g2") == F.col("x2"))
        split = common.saved(split.select("*", below.alias("below"), centre.alias("centre")), "trie-split")
        # The component totals below a centroid, with its own value, are its sum.
        sums = split.filter("below OR centre").groupBy(*comp).agg(*[F.sum(n).alias(f"t_{n}") for n in names])
        sums = common.saved(best.join(sums, comp), "trie-sums")
        results.append(split.filter("centre").join(sums.select(*comp, *[f"t_{n}" for n in names]), comp).select(
            "d", "g1", "g2", *[(F.col(f"add_{n}") + F.col(f"t_{n}")).alias(n) for n in names]))
        # Which goes to all nodes on the path up to the component's top.
        up = (path.join(sums.withColumnRenamed("xc", "conv"), "conv").filter("d < xd AND d >= cd")
              .select(*comp, "d", "g1", "g2", F.col("xsize").alias("less"), *[f"t_{n}" for n in names]))
        above = split.filter("NOT below AND NOT centre").join(up, [*comp, "d", "g1", "g2"], "left").select(
            *_TREE, "conv", *names,
            *[(F.col(f"add_{n}") + F.coalesce(f"t_{n}", F.lit(0))).alias(f"add_{n}") for n in names], *comp,
            (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"))
        under = split.filter("below").select(
            *_TREE, "conv", *names, *[f"add_{n}" for n in names], F.col("n1").alias("c1"), F.col("n2").alias("c2"),
            F.col("nd").alias("cd"), "size")
        parts = common.saved(above.unionByName(under), "trie-parts")
        large = common.saved(parts.groupBy(*comp).agg(F.max("size").alias("whole"))
                             .filter(F.col("whole") > local).select(*comp), "trie-large")
        settled.append(parts.join(large, comp, "left_anti").drop("size"))
        big = parts.join(large, comp, "left_semi") if large.limit(1).count() else None
    rest = settled[0]
    for more in settled[1:]:
        rest = rest.unionByName(more)
    schema = ", ".join(f"{c} long" for c in ["d", "g1", "g2", *names])
    out = (rest.repartition(*comp).sortWithinPartitions(*comp, "d")
           .mapInPandas(lambda it: _finish(it, names), schema))
    for more in results:
        out = out.unionByName(more)
    return out


# -------------------------------------------------------------------- the trie
def _hash_ends(batches):
    """Rows sorted by node and conversation: a node's ends as one stream."""
    key, state = None, None
    for pdf in batches:
        out = []
        for row in pdf[["d", "g1", "g2", "conv"]].itertuples(index=False, name=None):
            if row[:3] != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = row[:3], hashlib.sha256(str(row[3]).encode())
            else:
                state.update(b",%d" % row[3])
        if out:
            yield pd.DataFrame(out, columns=["d", "g1", "g2", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["d", "g1", "g2", "ends_sha256"])


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", family: int = FAMILY, heads: int = HEADS, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (its
    smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Turns go by number, null first; equal numbers by role, then by the SHA-256
    of the text.  Null roles and texts are empty.  Rows without a conversation
    id belong to no conversation.  Repeated rows are turns of their own.  An
    empty table has no nodes.  Other columns are not read.
    """
    spark = turns.sparkSession
    common.prepare(spark)
    rows, convs = rebuilt(turns, conv_col, turn_col, role_col, text_col, family, heads)
    path = common.saved(steps(rows, convs), "trie-steps")
    key = ["d", "g1", "g2"]
    nodes = path.groupBy(*key).agg(F.count(F.lit(1)).alias("n_convs"),
                                   F.min_by(F.struct("conv", "p1", "p2", "words"), "conv").alias("x"))
    nodes = common.saved(nodes.select(*key, "x.*", "n_convs"), "trie-labels")
    children = nodes.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("g1"),
                                             F.col("p2").alias("g2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = common.saved(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                         .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-tree")
    sums = rollup(nodes, path, ["leaves", "saved"], local)
    ends = path.join(convs, "conv").filter("d = len").select(*key, "conv")
    ends = ends.repartition(*key).sortWithinPartitions(*key, "conv").mapInPandas(
        _hash_ends, "d long, g1 long, g2 long, ends_sha256 string")
    # The root is the parent of a great many: known, not joined.
    first = nodes.agg(F.min("conv")).first()[0]
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("g1").alias("p1"), F.col("g2").alias("p2"),
                         F.col("conv").alias("up"))
    deep = nodes.filter("d > 1").join(above.filter("d > 1"), ["d", "p1", "p2"])
    near = nodes.filter("d <= 1").withColumn("up", F.when(F.col("d") == 1, F.lit(first)).cast("long"))
    out = (deep.unionByName(near.select(*deep.columns)).withColumnsRenamed({"leaves": "_l", "saved": "_s"})
           .join(sums, key).join(ends, key, "left"))
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("up").alias("parent_conv_id"),
                      "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(common.table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    from tablesync.llm.merkle import crc32_sql

    return rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            sha256(coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT c, c - c % 20 AS base, {crc32_sql('c::VARCHAR')} % 4 AS h, count(*) AS size FROM t GROUP BY c
), k AS (
  SELECT c.*, least(c.h, coalesce(b.size, 0)) AS taken FROM c LEFT JOIN c b ON b.c = c.base
), s AS (
  SELECT k.c, t.r AS d, role, text FROM k JOIN t ON t.c = k.base AND t.r <= k.taken
  UNION ALL
  SELECT k.c, t.r - k.h + k.taken, role, text FROM k JOIN t ON t.c = k.c AND t.r > k.h
), p AS (
  SELECT c, d, text, sha256(string_agg(octet_length(encode(role)) || ':' || role || octet_length(encode(text)) || ':' || text, '')
                     OVER (PARTITION BY c ORDER BY d)) AS g FROM s
  UNION ALL
  SELECT c, 0, '', '' FROM k
), m AS (
  SELECT c, d, g, text, min(c) OVER (PARTITION BY d, g) AS lab, count(*) OVER (PARTITION BY d, g) AS n FROM p
), l AS (
  SELECT k.c, max(m.d) AS len FROM k JOIN m ON m.c = k.c GROUP BY k.c
), nodes AS (
  SELECT m.lab, m.d, m.n, len(regexp_extract_all(m.text, '[^\x20\x09-\x0D]+')) AS w, u.lab AS up
  FROM m LEFT JOIN m u ON u.c = m.c AND u.d = m.d - 1 WHERE m.c = m.lab
), kids AS (
  SELECT up, d - 1 AS d, count(*) AS k FROM nodes WHERE d > 0 GROUP BY up, d
), v AS (
  SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids ON kids.up = nodes.lab AND kids.d = nodes.d
), sub AS (
  SELECT m.lab, m.d, count(*) FILTER (WHERE v.k = 0) AS leaves, sum((v.n - 1) * v.w) AS saved
  FROM m JOIN v ON v.lab = m.c AND v.d >= m.d GROUP BY m.lab, m.d
), e AS (
  SELECT m.lab, m.d, sha256(string_agg(m.c::VARCHAR, ',' ORDER BY m.c)) AS ends
  FROM m JOIN l ON l.c = m.c AND l.len = m.d GROUP BY m.lab, m.d
)
SELECT v.lab AS conv_id, v.d::BIGINT AS depth, v.up AS parent_conv_id, v.n::BIGINT AS n_convs,
       v.k::BIGINT AS n_children, sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens,
       coalesce(e.ends, sha256('')) AS ends_sha256
FROM v JOIN sub ON sub.lab = v.lab AND sub.d = v.d LEFT JOIN e ON e.lab = v.lab AND e.d = v.d
"""


OP11_SQL = _op11_sql()
