"""Merkle manifest of a table: every row's proof by a nested rollup.

Method: a leaf is the hash of a row.  Leaves are numbered within their tree
(a language) and the number is read in base 8: one column per digit.  Inside a
block of 8 x 8 x 8 leaves the digit columns are grouped away one after the
other, the last first; every grouping hashes its children and nests their
structs, so a block ends as one row that holds its whole subtree.  Blocks are
the leaves of the next tier, until each tree is one node; the trees' roots are
the leaves of one more tree.

Proofs come from the same rows: going down, a nested transform gives every
leaf of a block the hashes beside its path, followed by the block's own path,
and one explode emits them.  A block and its path meet by a union and a
grouping of two rows, not by a join.

A block holds 512 leaves however many rows a tree has, so a tree with a third
of all rows is spread like any other.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common
from tablesync.llm.ranks import ranked

FANOUT = 8
DIGITS = 3                      # digits grouped away within a block
BLOCK = FANOUT ** DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def encoded(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of a row's encoded values."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256)


def _hashes(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["h"]), "")


def _count(n: Column, level: int) -> Column:
    """Nodes of a tree ``level`` levels above ``n`` ones."""
    width = FANOUT ** level
    return F.floor((n + F.lit(width - 1)) / F.lit(width)).cast("long")


def tier(nodes: DataFrame) -> DataFrame:
    """``_tree, _n, _block, h, kids``: blocks of ``_tree, _n, _rank, h, p``
    nodes (``_n``: nodes of the tree, ``p``: what a node carries).  While a
    tree has several nodes each run of eight becomes their hash; a lone node
    stays itself."""
    rank = F.col("_rank")
    digits = [F.floor(rank / F.lit(FANOUT ** i)).cast("long") % FANOUT for i in range(DIGITS)]
    rows = nodes.select("_tree", "_n", F.floor(rank / F.lit(BLOCK)).cast("long").alias("_block"),
                        *[d.cast("int").alias(f"_d{i}") for i, d in enumerate(digits)], "h", "p")
    # Dealt by tree and block once: the groupings below are all inside it.
    rows = rows.repartition("_tree", "_block")
    child = F.struct(F.col("_d0").alias("d"), "h", "p")
    for level in range(DIGITS):
        keys = ["_tree", "_n", "_block", *[f"_d{i}" for i in range(DIGITS - 1, level, -1)]]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        several = _count(F.col("_n"), level) > 1
        rows = rows.withColumn("h", F.when(several, F.sha2(_hashes(F.col("kids")).cast("binary"), 256))
                               .otherwise(F.col("kids")[0]["h"]))
        child = F.struct(F.col(f"_d{level + 1}").alias("d"), "h", "kids") if level + 1 < DIGITS else None
    return rows


def _beside(nodes: Column, i: Column, several: Column) -> Column:
    """The hashes left and right of node ``i``, as a path of one step (none
    where the level has one node)."""
    step = F.struct(_hashes(F.slice(nodes, F.lit(1), i)).alias("left"),
                    _hashes(F.slice(nodes, i + 2, F.lit(FANOUT))).alias("right"))
    return F.when(several, F.array(step)).otherwise(F.array().cast(_PATH))


def _down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``p, path, top``: the nodes of ``blocks`` with their paths.  ``above``
    (``_tree, _block, path, top``) holds the blocks' own."""
    paths = above.select("_tree", "_block", F.lit(None).cast("long").alias("_n"),
                         F.lit(None).cast(blocks.schema["kids"].dataType).alias("kids"), "path", "top")
    rows = blocks.select("_tree", "_block", "_n", "kids", F.lit(None).cast(_PATH).alias("path"),
                         F.lit(None).cast(above.schema["top"].dataType).alias("top"))
    met = rows.unionByName(paths).groupBy("_tree", "_block").agg(
        F.max("_n").alias("_n"), *[F.element_at(F.collect_list(c), 1).alias(c) for c in ("kids", "path", "top")])
    n, up = F.col("_n"), F.col("path")

    def leaf(x2, i2, x1, i1):
        return lambda x, i: F.struct(x["p"].alias("p"), F.concat(
            _beside(x1["kids"], i, n > 1), _beside(x2["kids"], i1, _count(n, 1) > 1),
            _beside(F.col("kids"), i2, _count(n, 2) > 1), up).alias("path"))

    def middle(x2, i2):
        return lambda x1, i1: F.transform(x1["kids"], leaf(x2, i2, x1, i1))

    nodes = F.flatten(F.transform(F.col("kids"), lambda x2, i2: F.flatten(F.transform(x2["kids"], middle(x2, i2)))))
    return met.select("top", F.explode(nodes).alias("_e")).select("_e.p", "_e.path", "top")


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame] | None:
    """The tiers over ``nodes``, lowest first, and ``_tree, h`` of the roots;
    None for an empty table."""
    tiers = []
    while True:
        tiers.append(common.saved(tier(nodes), "merkle-tier"))
        nodes = tiers[-1].select("_tree", F.col("_block").alias("_rank"), _count(F.col("_n"), DIGITS).alias("_n"), "h")
        most = nodes.agg(F.max("_n")).first()[0]
        if most is None:
            return None
        if most == 1:
            return tiers, nodes.select("_tree", "h")
        nodes = nodes.withColumn("p", F.struct("_tree", F.col("_rank").alias("_block")))


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    for i, blocks in enumerate(reversed(tiers)):
        above = _down(blocks, above)
        if i + 1 < len(tiers):
            above = above.select("p._tree", "p._block", "path", "top")
    return above


def proofs(leaves: DataFrame, tree: str, order: list[str], leaf: str = "leaf") -> DataFrame | None:
    """One row per row of ``leaves``: ``p`` (the row), ``subroot`` (its tree's
    root), ``root`` and ``path`` (``array<struct<left, right>>``: from the leaf
    up to the root the hashes before and after the path, joined).  ``order``
    numbers a tree's leaves, nulls first; trees go by value, null first.  None
    for an empty table."""
    row = F.struct(*[common.quoted(c) for c in leaves.columns]).alias("p")
    flat = leaves.select(row, common.quoted(tree).alias("_tree"), common.quoted(leaf).alias("h"),
                         *[common.quoted(c).alias(f"_o{i}") for i, c in enumerate(order)])
    numbered = ranked(flat, ["_tree"], [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))] + [F.col("h")],
                      "merkle-leaves")
    grown = _grow(numbered.select("_tree", F.col("_size").alias("_n"), "_rank", "h", "p"))
    if grown is None:
        return None
    tiers, roots = grown
    # The trees' roots are the leaves of the one tree above.
    tops = ranked(roots, [], [F.col("_tree").asc_nulls_first()], "merkle-roots")
    forest, apex = _grow(tops.select(F.lit(0).alias("_tree"), F.col("_size").alias("_n"), "_rank", "h",
                                     F.struct("_tree", "h").alias("p")))
    start = apex.select("_tree", F.lit(0).cast("long").alias("_block"), F.array().cast(_PATH).alias("path"),
                        F.struct(F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root")).alias("top"))
    above = _descend(forest, start).select(
        F.col("p._tree").alias("_tree"), F.lit(0).cast("long").alias("_block"), "path",
        F.struct(F.col("p.h").alias("subroot"), F.col("top.root").alias("root")).alias("top"))
    above = common.saved(above, "merkle-top")
    return _descend(tiers, above).select("p", "top.subroot", "top.root", "path")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all hashes of a path, level by level."""
    text = F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
    return F.sha2(text.cast("binary"), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the hashes beside its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


_OUT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean")


def manifest(docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", tree_col: str = "lang",
             text_col: str = "text", fields=FIELDS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for
    each row of ``docs``.

    Rows that ``tampered`` picks have A-Z of their text lower-cased before
    their leaf is folded up again with the untampered hashes beside its path.
    Nulls are hashed as ``-``; rows without a language are a tree of their own,
    first; rows without an id come first in their tree; rows with one id go by
    leaf, so repeated rows are interchangeable; an empty table has no rows.
    Columns beside ``fields`` are not read.
    """
    cols = {c: common.quoted(c) for c in fields}
    changed = digest(*[common.ascii_lower(v) if c == text_col else v for c, v in cols.items()])
    leaves = docs.select(
        cols[id_col].alias("doc_id"), cols[tree_col].alias("tree"), digest(*cols.values()).alias("leaf"),
        F.when(tampered, changed).alias("other") if tampered is not None else F.lit(None).cast("string").alias("other"))
    found = proofs(leaves, "tree", ["doc_id"])
    if found is None:
        return docs.sparkSession.createDataFrame([], _OUT)
    root = folded(F.col("path"), F.coalesce("p.other", "p.leaf"))
    out = found.select("p.doc_id", "p.leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir):
    every_third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(common.table(spark, sf_dir, "documents"), every_third)


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII ``text`` as a DuckDB expression."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda k: ord(k)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"


def _enc(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(_enc(c) for c in FIELDS[:-1])

OP13_SQL = f"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, sha256({_HEAD} || {_enc('text')}) AS leaf,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0
              THEN sha256({_HEAD} || {_enc(_LOWER)}) END AS other FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rnk,
         count(*) OVER (PARTITION BY lang) AS n FROM l
), t AS (
  SELECT lang, 0 AS lvl, rnk, n, leaf AS h FROM r
  UNION ALL
  SELECT lang, lvl + 1, rnk // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY rnk))
  FROM t WHERE n > 1 GROUP BY lang, lvl, n, rnk // 8
), s AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rnk, count(*) OVER () AS n FROM t WHERE n = 1
), f AS (
  SELECT 0 AS lvl, rnk, n, h FROM s
  UNION ALL
  SELECT lvl + 1, rnk // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY rnk))
  FROM f WHERE n > 1 GROUP BY lvl, n, rnk // 8
), runs AS (
  SELECT lang, lvl, rnk // 8 AS run, list(h ORDER BY rnk) AS hs FROM t WHERE n > 1 GROUP BY lang, lvl, rnk // 8
), fruns AS (
  SELECT lvl, rnk // 8 AS run, list(h ORDER BY rnk) AS hs FROM f WHERE n > 1 GROUP BY lvl, rnk // 8
), up AS (
  SELECT rid, lang, 0 AS lvl, rnk, n, coalesce(other, leaf) AS h, '' AS proof FROM r
  UNION ALL
  SELECT u.rid, u.lang, u.lvl + 1, u.rnk // 8, (u.n + 7) // 8,
         sha256(array_to_string(hs[:u.rnk % 8], '') || u.h || array_to_string(hs[u.rnk % 8 + 2:], '')),
         proof || array_to_string(hs[:u.rnk % 8], '') || array_to_string(hs[u.rnk % 8 + 2:], '')
  FROM up u JOIN runs ON runs.lang IS NOT DISTINCT FROM u.lang AND runs.lvl = u.lvl AND runs.run = u.rnk // 8
  WHERE u.n > 1
), fup AS (
  SELECT u.rid, 0 AS lvl, s.rnk, s.n, u.h, u.proof, s.h AS subroot
  FROM up u JOIN s ON s.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
  UNION ALL
  SELECT u.rid, u.lvl + 1, u.rnk // 8, (u.n + 7) // 8,
         sha256(array_to_string(hs[:u.rnk % 8], '') || u.h || array_to_string(hs[u.rnk % 8 + 2:], '')),
         proof || array_to_string(hs[:u.rnk % 8], '') || array_to_string(hs[u.rnk % 8 + 2:], ''), subroot
  FROM fup u JOIN fruns ON fruns.lvl = u.lvl AND fruns.run = u.rnk // 8 WHERE u.n > 1
)
SELECT l.doc_id, l.leaf, e.subroot, g.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root,
       e.h = g.h AS verified
FROM l JOIN fup e ON e.rid = l.rid AND e.n = 1 CROSS JOIN (SELECT h FROM f WHERE n = 1) g
"""
