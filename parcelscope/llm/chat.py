"""Chat formatting (operator 3), in DataFrame functions alone.

Chat logs often hold a conversation once per turn, each time one turn longer.
Every turn gets the rolling hash of the conversation up to it. A conversation
whose last hash is an inner hash of a longer one is a snapshot of it and goes,
by an anti-join on (turns, hash); of equal conversations the smallest id stays.
What is left is rendered turn by turn between role marks.

A conversation is worked on in blocks of ``BLOCK`` turns, by their places: sums
within blocks first, then the sums of the blocks before, from a table with one row
per block. The places come from range partitions, so a very long conversation is
spread over tasks and never gathered in one row, whatever its turn numbers are.

Defined cases: a null role or text counts as empty; a null turn comes first;
turns are ordered by number, then role, then text; rows equal in all four
columns count once; rows without a conversation id form a conversation of their
own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import indexed_sort
from .common import cut

BLOCK = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_BITS = 40


def _part(seed: int) -> Column:
    """A hash of a turn and its place, small enough to be summed for 2^23 turns."""
    return F.pmod(F.xxhash64(F.lit(seed), "pos", "role", "text"), F.lit(1 << _BITS))


def prefix_hashes(df: DataFrame) -> DataFrame:
    """(conv_id, block, pos, role, text, n_turns, h1, h2): place and rolling hashes of every turn.

    The hash of a prefix is the sum of its turns' hashes, each made with the
    turn's place, kept twice with different seeds (80 bits).
    """
    turns = (df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
             .distinct())
    placed = (indexed_sort(turns, ["turn", "role", "text"], ["conv_id"], "place", size_col="n_turns")
              .select("conv_id", F.floor(F.col("place") / BLOCK).cast("long").alias("block"),
                      (F.col("place") + 1).alias("pos"), "role", "text", "n_turns"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("h1", F.sum(_part(1)).over(upto)).withColumn("h2", F.sum(_part(2)).over(upto))
    totals = (placed.groupBy("conv_id", "block").agg(F.sum(_part(1)).alias("t1"), F.sum(_part(2)).alias("t2"))
              .withColumn("b1", F.coalesce(F.sum("t1").over(before), F.lit(0)))
              .withColumn("b2", F.coalesce(F.sum("t2").over(before), F.lit(0))))
    return (summed.join(totals, summed.conv_id.eqNullSafe(totals.conv_id) & (summed.block == totals.block))
            .select(summed.conv_id, summed.block, "pos", "role", "text", "n_turns",
                    (F.col("h1") + F.col("b1")).alias("h1"), (F.col("h2") + F.col("b2")).alias("h2")))


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other one continues or repeats."""
    inner = hashed.filter(F.col("pos") < F.col("n_turns")).groupBy("pos", "h1", "h2").agg(F.count("*").alias("n"))
    one = (hashed.filter(F.col("pos") == F.col("n_turns")).groupBy("pos", "h1", "h2")
           .agg(F.min("conv_id").alias("conv_id")))
    return one.join(inner, ["pos", "h1", "h2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render_conversations(df: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, text of every maximal conversation.

    A part holds the turns of one block, so only conversations of more than
    ``BLOCK`` turns have several; parts joined in order are the whole chat.
    """
    hashed = cut(prefix_hashes(df), "chat-turns")
    keep = cut(maximal(hashed), "chat-maximal")
    # by block, so a long conversation isn't one key of the join
    last = F.floor((F.col("n_turns") - 1) / BLOCK).cast("long")
    mine = keep.select(F.col("conv_id").alias("keep_id"),
                       F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("keep_block"))
    turn = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE + "\n"))
    kept = hashed.join(mine, hashed.conv_id.eqNullSafe(F.col("keep_id")) & (F.col("block") == F.col("keep_block")))
    return (kept.groupBy("conv_id", "block", "n_turns")
            .agg(F.array_sort(F.collect_list(F.struct("pos", turn.alias("s")))).alias("turns"))
            .select("conv_id", F.col("block").alias("part"), "n_turns",
                    F.array_join(F.col("turns.s"), "").alias("text")))


#: The same rows for DuckDB.
SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations),
s AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
      md5(string_agg(md5(role || chr(1) || text), '') OVER w) AS h
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
one AS (SELECT n, h, min(conv_id) AS conv_id FROM s WHERE pos = n GROUP BY n, h),
keep AS (SELECT conv_id, n FROM one
         WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.pos = one.n AND s.h = one.h AND s.n > one.n))
SELECT s.conv_id, CAST(floor(s.turn / {BLOCK}) AS BIGINT) AS part, keep.n AS n_turns,
       string_agg('{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10), '' ORDER BY pos) AS text
FROM s JOIN keep ON s.conv_id = keep.conv_id
GROUP BY s.conv_id, floor(s.turn / {BLOCK}), keep.n
"""
