"""Merkle dataset manifest (operator 13).

Every row is a leaf; the leaves of a group, in the order of their ids, form a tree
of fixed arity, and the groups' roots form a tree of their own above them. A level
is built by sibling-shift self-joins: each node computes its siblings' indices (its
own XOR 1 in a binary tree, the other slots of its run otherwise) and is joined
with them by (group, index); rows of slot zero then emit the parents. On the way
down every node takes over its parent's proof, so a leaf ends with the siblings of
all levels. A proof is folded with a leaf to the root it leads to.

All joins are on (group, index), which is unique on one side and at most ``arity``
rows on the other, so a group that holds a third of all rows is spread like any
other. Places come from range partitions (``indexed_sort``); each level is written
once. Only the greatest group's size and the root go to the driver.

Defined cases: a null value is hashed as ``-``; a null group is a group of its own
and comes first, a null id comes first in its group; rows of one id are ordered by
their leaf, so rows equal in all hashed columns are leaves beside each other; a
lone leaf is its group's root, a lone group's root the root; an empty table gives
an empty result; columns that aren't hashed are ignored, whatever their names. Rows
with a null id are never tampered with.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import indexed_sort
from .common import cut

ARITY = 3
#: What a leaf of ``documents`` hashes, in this order.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(values: list[Column]) -> Column:
    """Digest of the values, each ``-`` if null, else its UTF-8 length, a colon and itself."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*[part(c) for c in values])


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (g, idx, h, ...) with the digests of the siblings ``left`` and ``right`` of each."""
    slot = F.pmod(F.col("idx"), F.lit(arity))
    out, found = nodes, []
    for shift in range(1, arity):
        at = (F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2
              else F.col("idx") - slot + F.pmod(slot + shift, F.lit(arity)))
        other = nodes.select(F.col("g").alias("_g"), F.col("idx").alias("_idx"), F.col("h").alias(f"_h{shift}"))
        out = (out.withColumn("_at", at).join(other, (F.col("g") == F.col("_g")) & (F.col("_at") == F.col("_idx")), "left")
               .drop("_g", "_idx", "_at"))
        found.append(F.struct(F.pmod(slot + shift, F.lit(arity)).alias("slot"), F.col(f"_h{shift}").alias("h")))
    run = F.array_sort(F.filter(F.array(*found), lambda x: x.h.isNotNull()))

    def joined(side) -> Column:
        return F.array_join(F.transform(F.filter(run, side), lambda x: x.h), "")
    return out.select(*nodes.columns, joined(lambda x: x.slot < slot).alias("left"),
                      joined(lambda x: x.slot > slot).alias("right"))


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above a level: one for each run, from the row of slot zero."""
    return (level.filter(F.pmod(F.col("idx"), F.lit(arity)) == 0)
            .select("g", (F.col("idx") / arity).cast("long").alias("idx"), digest(F.col("h"), F.col("right")).alias("h"),
                    F.ceil(F.col("n") / arity).cast("long").alias("n")))


def forest(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels, from the leaves up, and the roots that each level of nodes holds.

    ``nodes``: g (never null), idx from 0 without gaps in each group, h, n (the
    group's size); further columns stay at the lowest level.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], [nodes.filter("n = 1").select("g", "h")]
    while most > 1:
        levels.append(cut(with_siblings(nodes.filter("n > 1"), arity), name))
        nodes, most = parents(levels[-1], arity), ceil(most / arity)
        roots.append(nodes.filter("n = 1").select("g", "h"))
    return levels, roots


def with_proofs(nodes: DataFrame, levels: list[DataFrame], roots: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``subroot`` and ``proof``, the siblings level by level up to
    the root of all; ``above`` has g, subroot and each group's own ``proof``."""
    def ended(at: int) -> DataFrame:
        tops = roots[at].select(F.col("g").alias("_r"))
        return above.join(tops, F.col("g") == F.col("_r")).select("g", F.lit(0).cast("long").alias("idx"), "subroot", "proof")

    upper = None
    for at in range(len(levels) - 1, -1, -1):
        upper = ended(at + 1) if upper is None else upper.select("g", "idx", "subroot", "proof").union(ended(at + 1))
        up = upper.select(F.col("g").alias("_g"), F.col("idx").alias("_idx"), "subroot", F.col("proof").alias("_proof"))
        level = levels[at].withColumn("_up", (F.col("idx") / arity).cast("long"))
        upper = (level.join(up, (F.col("g") == F.col("_g")) & (F.col("_up") == F.col("_idx")))
                 .withColumn("proof", F.concat(F.array(F.struct("left", "right")).cast(_PROOF), "_proof"))
                 .drop("_up", "_g", "_idx", "_proof", "left", "right"))
    lone = (nodes.filter("n = 1").join(above.select(F.col("g").alias("_g"), "subroot", "proof"), F.col("g") == F.col("_g"))
            .drop("_g"))
    return lone if upper is None else upper.unionByName(lone)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, x: digest(x.left, node, x.right))


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """``leaves`` (id, grp, leaf, further columns) with ``subroot``, ``root`` and ``proof``."""
    if arity < 2:
        raise ValueError("a tree needs two slots at least")
    rows = indexed_sort(cut(leaves, "merkle-leaves"), ["id", "leaf"], ["grp"], "idx", size_col="n")
    # a key that is never null: joins need no null-safe comparison
    nodes = cut(rows.withColumn("g", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("-"))).withColumnRenamed("leaf", "h"),
                "merkle-nodes")
    levels, roots = forest(nodes, arity, "merkle-level")
    tops = roots[0]
    for r in roots[1:]:
        tops = tops.union(r)
    tops = cut(tops, "merkle-subroots")
    # '-' (null) sorts before '=', so the key has the order of the groups
    whole = tops.count()
    top = cut(indexed_sort(tops.withColumnRenamed("g", "key"), ["key"], None, "idx")
              .select(F.lit("").alias("g"), "idx", "h", F.lit(whole).cast("long").alias("n"), "key"), "merkle-groups")
    top_levels, top_roots = forest(top, arity, "merkle-top")
    root = None
    for r in top_roots:
        root = root or next((x.h for x in r.take(1)), None)
    start = top.sparkSession.range(1).select(F.lit("").alias("g"), F.lit(root).cast("string").alias("subroot"),
                                             F.array().cast(_PROOF).alias("proof"))
    above = cut(with_proofs(top, top_levels, top_roots, start, arity)
                .select(F.col("key").alias("g"), F.col("h").alias("subroot"), "proof"), "merkle-above")
    out = with_proofs(nodes, levels, roots, above, arity)
    return (out.withColumnRenamed("h", "leaf").withColumn("root", F.lit(root).cast("string"))
            .select(*leaves.columns, "subroot", "root", "proof"))


def verified_manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it, as tampered with
    where crc32(doc_id) is even, still leads to the root."""
    cols = [F.col(c) for c in HASHED]
    tampered = cols[:-1] + [F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    leaves = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("grp"), leaf_hash(cols).alias("leaf"),
                         F.when(even & F.contains("text", F.lit("\n")), leaf_hash(tampered)).alias("other"))
    out = manifest(leaves, arity)
    siblings = F.array_join(F.transform("proof", lambda x: F.concat(x.left, x.right)), "")
    out = out.withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("proof")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _crc32(text: str) -> str:
    """DuckDB expression: unsigned crc32 of an ASCII text."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {step}), 4294967295)"


def _part(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"


#: The same rows for DuckDB.
SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, sha256({' || '.join(_part(c) for c in HASHED)}) AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0
              THEN sha256({' || '.join(_part(c if c != 'text' else "replace(text, chr(10), '')") for c in HASHED)}) END AS other
  FROM documents),
k AS (SELECT *, coalesce('=' || source, '-') AS g,
      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
      count(*) OVER (PARTITION BY source) AS n FROM l),
t AS (SELECT g, 0 AS lv, idx, leaf AS h, n FROM k
      UNION ALL
      SELECT g, lv + 1, idx // {ARITY}, sha256(string_agg(h, '' ORDER BY idx)), CAST(ceil(n / {ARITY}) AS BIGINT)
      FROM t WHERE n > 1 GROUP BY g, lv, idx // {ARITY}, n),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lv, idx, subroot AS h, n FROM s
      UNION ALL
      SELECT lv + 1, idx // {ARITY}, sha256(string_agg(h, '' ORDER BY idx)), CAST(ceil(n / {ARITY}) AS BIGINT)
      FROM u WHERE n > 1 GROUP BY lv, idx // {ARITY}, n),
sib AS (SELECT a.g, a.lv, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
        coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
        FROM t a JOIN t b ON a.g = b.g AND a.lv = b.lv AND a.idx // {ARITY} = b.idx // {ARITY}
        WHERE a.n > 1 GROUP BY a.g, a.lv, a.idx),
top AS (SELECT a.lv, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
        coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
        FROM u a JOIN u b ON a.lv = b.lv AND a.idx // {ARITY} = b.idx // {ARITY}
        WHERE a.n > 1 GROUP BY a.lv, a.idx),
f AS (SELECT doc_id, g, idx AS leaf_idx, leaf, 0 AS lv, idx, '' AS proof, coalesce(other, leaf) AS h FROM k
      UNION ALL
      SELECT doc_id, f.g, leaf_idx, leaf, f.lv + 1, f.idx // {ARITY}, proof || lft || rgt, sha256(lft || h || rgt)
      FROM f JOIN sib ON f.g = sib.g AND f.lv = sib.lv AND f.idx = sib.idx),
m AS (SELECT doc_id, leaf, subroot, 0 AS lv, s.idx, proof, f.h
      FROM (SELECT *, max(lv) OVER (PARTITION BY g) AS top_lv FROM f) f JOIN s ON f.g = s.g WHERE f.lv = top_lv
      UNION ALL
      SELECT doc_id, leaf, subroot, m.lv + 1, m.idx // {ARITY}, proof || lft || rgt, sha256(lft || m.h || rgt)
      FROM m JOIN top ON m.lv = top.lv AND m.idx = top.idx)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, m.h AS folded_root, m.h = r.h AS verified
FROM m, (SELECT h FROM u WHERE n = 1) r WHERE m.lv = (SELECT max(lv) FROM u)
"""
