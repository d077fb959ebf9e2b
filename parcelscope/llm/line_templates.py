"""Line dedup by log templates (operator 2), in DataFrame functions alone.

A tree of fixed depth sorts lines: first by their number of tokens, then by
their leading tokens, where a token with a digit counts as a variable field.
Within a leaf a place keeps the token that lines of enough documents have
there; every other token becomes a variable field. What comes out is the line's
template. Templates of enough constant places that recur in enough different
texts are dropped, but for their first line (smallest id, then text, told by its
hash, then place).

With ``exact``, lines of enough tokens that are equal, white space apart, in two
different texts or more are dropped as well, but for their first one, whatever
their template and their share of digits. Lines are the unit of both: a passage
that recurs within longer lines is not found.

Only leaves that occur in enough texts go beyond the first count, so the tokens
of ordinary prose are never shuffled.

Defined cases: a null text stays null, an empty one empty; lines of fewer than
``MIN_TOKENS`` tokens stay; equal texts count as one document; rows with equal
id and text are treated alike, so a repeated row keeps its first lines each
time; a null id sorts first; an empty table gives an empty result; all other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_true, cut

DEPTH = 3
MIN_TOKENS = 4
#: Different texts that make a template recur.
MIN_DOCS = 3
#: Least share of constant places in a template.
CONSTANT = 0.5
FIELD = "<*>"


def masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))


def lines_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, pos, leaf, n, line) of every line with enough tokens."""
    text = F.col(text_col)
    # runs of white space count as one space; most texts have none, and are not searched for them
    runs = any_true([F.contains(text, F.lit(x)) for x in ("  ", "\t", "\x0b", "\f", "\r")])
    # hashed and split before the lines are dealt out, so it is done once per text
    whole = df.filter(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"),
                                               runs.alias("runs"), F.split(text, "\n").alias("lines"))
    line = (whole.select("id", "th", "runs", F.posexplode("lines").alias("pos", "line"))
            .withColumn("line", F.trim("line"))
            .withColumn("line", F.when(F.col("runs"), F.regexp_replace("line", r"\s+", " ")).otherwise(F.col("line"))))
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    head = F.substring_index("line", " ", DEPTH)
    head = F.when(head.rlike("[0-9]"), F.array_join(masked(F.split(head, " ")), " ")).otherwise(head)
    return (line.withColumn("n", n).filter(F.col("n") >= MIN_TOKENS)
            .select("id", "th", "pos", F.xxhash64("n", head).alias("leaf"), "n", "line"))


def recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """(id, th, bad): the places of the lines to drop, by row."""
    lines = lines_of(df, id_col, text_col)
    hot = cut(lines.select("leaf", "th").distinct().groupBy("leaf").count()
              .filter(F.col("count") >= min_docs).select("leaf"), "template-leaves")
    # a small table of leaves is broadcast by Spark's own threshold, a large one merge-joined
    found = cut(lines.join(hot, "leaf", "left_semi")
                .select("id", "th", "pos", "leaf", "n", F.xxhash64("line").alias("lh"),
                        masked(F.split("line", " ")).alias("tokens")), "template-lines")
    # one row per different line of a leaf, weighted by the texts that have it
    texts = (found.select("leaf", "lh", "th").distinct().groupBy("leaf", "lh")
             .agg(F.count("*").alias("texts")))
    once = found.groupBy("leaf", "lh").agg(F.max("n").alias("n"), F.max("tokens").alias("tokens"))
    places = (once.join(texts, ["leaf", "lh"])
              .select("leaf", "lh", "n", "texts", F.posexplode("tokens").alias("i", "token")))
    kept = (places.groupBy("leaf", "i", "token").agg(F.sum("texts").alias("support"))
            .filter((F.col("support") >= min_docs) & (F.col("token") != FIELD))
            .select("leaf", "i", "token", F.lit(True).alias("fixed")))
    template = (places.join(kept, ["leaf", "i", "token"], "left")
                .groupBy("leaf", "lh")
                .agg(F.bit_xor(F.when(F.col("fixed"), F.xxhash64("i", "token"))).alias("template"),
                     F.count("fixed").alias("n_fixed"), F.max("n").alias("n"))
                .filter(F.col("n_fixed") >= constant * F.col("n"))
                .select("leaf", "lh", "template"))
    of_line = cut(found.select("id", "th", "pos", "leaf", "lh").join(template, ["leaf", "lh"])
                  .select("id", "th", "pos", "leaf", "template"), "template-of-line")
    recurring = (of_line.select("leaf", "template", "th").distinct()
                 .groupBy("leaf", "template").count().filter(F.col("count") >= min_docs)
                 .select("leaf", "template"))
    first = of_line.groupBy("leaf", "template").agg(F.min(F.struct("id", "th", "pos")).alias("first"))
    drop = (of_line.join(recurring.join(first, ["leaf", "template"]), ["leaf", "template"])
            .filter(~F.struct("id", "th", "pos").eqNullSafe(F.col("first"))))
    return drop.groupBy("id", "th").agg(F.collect_set("pos").alias("bad"))


def equal_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, bad): the places of lines that are equal in several different texts,
    but for the first of each."""
    lines = lines_of(df, id_col, text_col).select("id", "th", "pos", F.xxhash64("line").alias("lh"))
    # two different texts have a least and a greatest hash: no list of texts is made
    twice = cut(lines.groupBy("lh").agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
                .filter("lo <> hi").select("lh"), "equal-line-hashes")
    found = cut(lines.join(twice, "lh", "left_semi"), "equal-lines")
    first = found.groupBy("lh").agg(F.min(F.struct("id", "th", "pos")).alias("first"))
    drop = found.join(first, "lh").filter(~F.struct("id", "th", "pos").eqNullSafe(F.col("first")))
    return drop.groupBy("id", "th").agg(F.collect_set("pos").alias("bad"))


def drop_recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = MIN_DOCS, constant: float = CONSTANT,
                         dropped_col: str | None = None, exact: bool = False) -> DataFrame:
    """``df`` with the recurring lines cut out of its texts, and with ``exact`` those
    equal in two texts; ``dropped_col`` names an added column with the number of
    lines dropped."""
    bad = recurring_lines(df, id_col, text_col, min_docs, constant)
    if exact:
        bad = (bad.union(equal_lines(df, id_col, text_col)).groupBy("id", "th")
               .agg(F.array_distinct(F.flatten(F.collect_list("bad"))).alias("bad")))
    bad = bad.select(F.struct("id", "th").alias("_row"), F.col("bad").alias("_bad"))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_all"), key.alias("_key"))
    out = rows.join(bad, (F.col("_key.id").eqNullSafe(F.col("_row.id")))
                    & (F.col("_key.th") == F.col("_row.th")), "left")
    text = F.col(f"_all.{text_col}")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("_bad", i)), "\n")
    cols = [F.when(F.col("_bad").isNull(), text).otherwise(left).alias(c) if c == text_col
            else F.col(f"_all.{c}").alias(c) for c in df.columns]
    if dropped_col:
        cols.append(F.coalesce(F.size("_bad"), F.lit(0)).alias(dropped_col))
    return out.select(*cols)


#: The same rows for DuckDB, with ``exact``.
SQL = f"""
WITH d AS (SELECT doc_id AS id, text, string_split(text, chr(10)) AS ls FROM documents),
l0 AS (SELECT id, text, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
l1 AS (SELECT id, text, pos, string_split(regexp_replace(trim(line), '\\s+', ' ', 'g'), ' ') AS raw FROM l0),
l2 AS (SELECT id, text, pos, len(raw) AS n, raw,
       list_transform(raw, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS toks
       FROM l1 WHERE len(raw) >= {MIN_TOKENS}),
l AS (SELECT *, row(n, toks[1:{DEPTH}]) AS leaf FROM l2),
hot AS (SELECT leaf FROM l GROUP BY leaf HAVING count(DISTINCT text) >= {MIN_DOCS}),
f AS (SELECT l.* FROM l JOIN hot USING (leaf)),
u AS (SELECT leaf, raw, any_value(toks) AS toks, any_value(n) AS n, count(DISTINCT text) AS texts
      FROM f GROUP BY leaf, raw),
p AS (SELECT leaf, raw, n, texts, unnest(toks) AS tok, unnest(range(len(toks))) AS i FROM u),
k AS (SELECT leaf, i, tok FROM p WHERE tok <> '{FIELD}' GROUP BY leaf, i, tok HAVING sum(texts) >= {MIN_DOCS}),
t AS (SELECT p.leaf, raw, any_value(n) AS n, count(k.tok) AS fixed,
      list(CASE WHEN k.tok IS NULL THEN '{FIELD}' ELSE k.tok END ORDER BY p.i) AS tpl
      FROM p LEFT JOIN k ON p.leaf = k.leaf AND p.i = k.i AND p.tok = k.tok GROUP BY p.leaf, raw),
lt AS (SELECT f.id, f.text, f.pos, f.leaf, t.tpl FROM f JOIN t ON f.leaf = t.leaf AND f.raw = t.raw
       WHERE t.fixed >= {CONSTANT} * t.n),
r AS (SELECT leaf, tpl, min(row(id, pos)) AS first FROM lt GROUP BY leaf, tpl
      HAVING count(DISTINCT text) >= {MIN_DOCS}),
eq AS (SELECT raw, min(row(id, pos)) AS first FROM l2 GROUP BY raw HAVING count(DISTINCT text) >= 2),
gone AS (SELECT lt.id, lt.pos FROM lt JOIN r ON lt.leaf = r.leaf AND lt.tpl = r.tpl WHERE row(lt.id, lt.pos) <> r.first
         UNION SELECT l2.id, l2.pos FROM l2 JOIN eq ON l2.raw = eq.raw WHERE row(l2.id, l2.pos) <> eq.first),
bad AS (SELECT id, list(pos) AS bad FROM gone GROUP BY id)
SELECT d.id AS doc_id,
       CASE WHEN bad IS NULL THEN d.text ELSE array_to_string(
         list_filter(d.ls, lambda x, i: NOT list_contains(bad.bad, i - 1)), chr(10)) END AS text,
       CAST(coalesce(len(bad.bad), 0) AS INTEGER) AS n_dropped
FROM d LEFT JOIN bad ON d.id = bad.id
"""
