"""Conversation structure repair (operator 12).

A conversation is repaired to ``(s?(ua)+)?`` (an optional system turn, then pairs
of user and assistant) by the cheapest edits: keep, rerole, delete, insert. The
edit lattice has a node for each (rows consumed, state of the pattern). A
bidirectional Dijkstra grows heaps from both ends, goes on until no crossing as
cheap as the best can be missing, and takes the least audit (its edits' initials)
among all crossings of that cost. From a given state an audit leads along one path
only, so two audits of equal cost to one node never are prefixes of each other:
the least audit of a whole is made of the least audits of its parts.

So a conversation of any length is cut into blocks of ``BLOCK`` rows by their
places, numbered over range partitions. A block, one character per row, gives its
cheapest edits for each state at its ends; the tables of ``FAN`` neighbouring
blocks are combined until one is left. Texts go by none of these groups. They meet
their audit once, streamed in order through the task that hashes the conversation:
its memory is a batch of rows and the audit. (One digest over the whole
conversation is sequential by its nature, and so is that task.)

Defined cases: a null role or text counts as one space, a null turn comes first;
rows without a conversation id form a conversation of their own; rows of one turn
are ordered by role, then text; roles count by their first letter, and roles of
other letters can only be reroled or deleted; empty and blank texts are deleted; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import indexed_sort
from .common import cut
from .merkle import _crc32

BLOCK, FAN = 512, 64
COST = {"K": 0, "D": 3, "R": 2, "I": 2}
TRUNCATED = 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES, DONE = 4, (0, 3)
#: The state that a role's initial leads to.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The turn that can be inserted or reroled to in a state.
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"u": "user", "a": "assistant"}
#: A row's code: its initial (o: any other), upper case if truncated; x if it must go.
CODES = "suaoSUAOx"
LEGAL = ("su", "ua", "au")


def row_edits(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, state after, cost) for a row in a state."""
    out = [("D", state, COST["D"])]
    if code == "x":
        return out
    more = TRUNCATED if code.isupper() else 0
    after = AFTER.get((state, code.lower()))
    if after is not None:
        out.append(("K", after, COST["K"] + more))
    out.append(("R", AFTER[state, WANTED[state]], COST["R"] + more))
    return out


_ROWS = {(c, s): row_edits(c, s) for c in CODES for s in range(STATES)}
_ROWS_BACK: dict[tuple[str, int], list[tuple[str, int, int]]] = {(c, s): [] for c in CODES for s in range(STATES)}
for (_c, _s), _edits in _ROWS.items():
    for _e, _t, _w in _edits:
        _ROWS_BACK[_c, _t].append((_e, _s, _w))
_INSERT = {s: AFTER[s, w] for s, w in WANTED.items()}
_INSERT_BACK = {t: [s for s in _INSERT if _INSERT[s] == t] for t in range(STATES)}


def cheapest_edits(codes: str, start: int = 0, goals: tuple[int, ...] = DONE) -> tuple[int, str] | None:
    """(cost, least audit) from ``start`` to one of ``goals``, or None if none leads there.

    Nodes of equal cost are settled by rows consumed, from either end, so a node's
    audit is final when it is settled: free edits (keep) only lead to later ones.
    """
    n = len(codes)
    fore = {(0, start): (0, "")}
    back = {(n, g): (0, "") for g in goals}
    heap_f, heap_b = [(0, 0, start)], [(0, -n, g) for g in goals]
    done_f: set[tuple[int, int]] = set()
    done_b: set[tuple[int, int]] = set()
    best = 0 if (0, start) in back else float("inf")

    def ahead(i: int, s: int) -> list[tuple[str, tuple[int, int], int]]:
        out = [("I", (i, _INSERT[s]), COST["I"])]
        if i < n:
            out += [(e, (i + 1, t), w) for e, t, w in _ROWS[codes[i], s]]
        return out

    while heap_f and heap_b and heap_f[0][0] + heap_b[0][0] <= best:
        if heap_f[0][0] < heap_b[0][0] or (heap_f[0][0] == heap_b[0][0] and len(done_f) <= len(done_b)):
            _, i, s = heappop(heap_f)
            if (i, s) in done_f:
                continue
            done_f.add((i, s))
            cost, audit = fore[i, s]
            for e, to, w in ahead(i, s):
                new = (cost + w, audit + e)
                if to not in done_f and (to not in fore or new < fore[to]):
                    if to not in fore or new[0] < fore[to][0]:
                        heappush(heap_f, (new[0], *to))
                    fore[to] = new
                if to in back:
                    best = min(best, new[0] + back[to][0])
        else:
            _, i, s = heappop(heap_b)
            i = -i
            if (i, s) in done_b:
                continue
            done_b.add((i, s))
            cost, audit = back[i, s]
            sources = [("I", (i, f), COST["I"]) for f in _INSERT_BACK[s]]
            if i:
                sources += [(e, (i - 1, f), w) for e, f, w in _ROWS_BACK[codes[i - 1], s]]
            for e, at, w in sources:
                new = (cost + w, e + audit)
                if at not in done_b and (at not in back or new < back[at]):
                    if at not in back or new[0] < back[at][0]:
                        heappush(heap_b, (new[0], -at[0], at[1]))
                    back[at] = new
                if at in fore:
                    best = min(best, new[0] + fore[at][0])
    # every node of a cheapest path is settled from one end or both, so some edge of it crosses over;
    # the ends themselves are final from the beginning
    done_f.add((0, start))
    done_b.update((n, g) for g in goals)
    found = [fore[v][1] + back[v][1] for v in done_f & done_b if fore[v][0] + back[v][0] == best]
    for v in done_f:
        for e, to, w in ahead(*v):
            if to in done_b and fore[v][0] + w + back[to][0] == best:
                found.append(fore[v][1] + e + back[to][1])
    return (int(best), min(found)) if found else None


# ---------------------------------------------------------------- blocks

#: The end of a table's entry that has reached the goal.
_END = STATES


def block_table(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit): the cheapest edits of a block by the states at its ends."""
    out = []
    for s in [0] if first else range(STATES):
        for end, goals in [(_END, DONE)] if last else [(e, (e,)) for e in range(STATES)]:
            got = cheapest_edits(codes, s, goals)
            if got:
                out.append((s, end, *got))
    return out


def combined(tables: list[list[tuple[int, int, int, str]]]) -> list[tuple[int, int, int, str]]:
    """The table of neighbouring blocks together."""
    whole = {(s, e): (c, a) for s, e, c, a in tables[0]}
    for t in tables[1:]:
        by: dict[tuple[int, int], tuple[int, str]] = {}
        for (s, m), (cost, audit) in whole.items():
            for m2, e, c, a in t:
                if m2 == m:
                    new = (cost + c, audit + a)
                    if (s, e) not in by or new < by[s, e]:
                        by[s, e] = new
        whole = by
    return [(s, e, c, a) for (s, e), (c, a) in whole.items()]


_ENTRY = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_STATS = ("blank", "duplicate", "truncated", "illegal", "n_turns")
_BLOCK_SCHEMA = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("n_blocks", pa.int64()), ("initials", pa.string()),
                           ("lo", pa.int64()), ("hi", pa.int64()), *[(c, pa.int64()) for c in _STATS], ("edits", _ENTRY)])
_BLOCK_DDL = ("conv_id long, block long, n_blocks long, initials string, lo long, hi long, " + ", ".join(f"{c} long" for c in _STATS)
              + ", edits array<struct<s:int,e:int,cost:long,audit:string>>")


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with codes -> blocks with tables; ``initials`` become the first and last."""
    known: dict[tuple, list] = {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            key = (r["codes"], r["block"] == 0, r["block"] == r["n_blocks"] - 1)
            if key not in known:
                if len(known) >= 10_000:
                    known.clear()
                known[key] = [dict(zip(("s", "e", "cost", "audit"), x)) for x in block_table(*key)]
            ini = r["initials"]
            out.append({c: r.get(c) for c in _BLOCK_SCHEMA.names} | {"illegal": _illegal(ini), "initials": ini[0] + ini[-1],
                                                                     "edits": known[key]})
        yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_SCHEMA)


def _merged(group: pa.Table) -> pa.Table:
    """The blocks of one group as one block."""
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    out = {c: sum(r[c] for r in rows) for c in _STATS}
    for a, b in zip(rows, rows[1:]):
        out["illegal"] += a["initials"][-1] + b["initials"][0] not in LEGAL
        # rows are in the order of turns: a turn in two blocks is the last of one and the first of the other
        out["n_turns"] -= a["hi"] is not None and a["hi"] == b["lo"]
    edits = combined([[(x["s"], x["e"], x["cost"], x["audit"]) for x in r["edits"]] for r in rows])
    lo, hi = [r["lo"] for r in rows if r["lo"] is not None], [r["hi"] for r in rows if r["hi"] is not None]
    out |= {"conv_id": rows[0]["conv_id"], "block": rows[0]["block"] // FAN, "n_blocks": -(-rows[0]["n_blocks"] // FAN),
            "initials": rows[0]["initials"][0] + rows[-1]["initials"][-1], "lo": min(lo, default=None), "hi": max(hi, default=None),
            "edits": [dict(zip(("s", "e", "cost", "audit"), x)) for x in edits]}
    return pa.Table.from_pylist([out], schema=_BLOCK_SCHEMA)


# ---------------------------------------------------------------- rows

def ended(text: Column) -> Column:
    return text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def placed_rows(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with pos (from 0) and n_rows of its conversation, and what is told of the text."""
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumns({"is_blank": _blank(F.col("text")), "is_ended": ended(F.col("text")),
                             "h1": F.xxhash64(F.lit(1), "role", "text"), "h2": F.xxhash64(F.lit(2), "role", "text")})
    return indexed_sort(rows, ["turn", "role", "text"], ["conv_id"], "pos", size_col="n_rows")


def coded_blocks(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per block: its rows' codes and initials in order, counts of faults and turns."""
    rows = placed.drop("text").withColumn("i", F.substring("role", 1, 1))
    rows = rows.withColumn("i", F.when(F.col("i").isin("s", "u", "a"), F.col("i")).otherwise("o"))
    # a blank row isn't a duplicate: only texts that occur twice and aren't blank are looked up
    again = (rows.filter(~F.col("is_blank")).groupBy("conv_id", "h1", "h2")
             .agg(F.min("pos").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
             .select(F.col("conv_id").alias("_c"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"))
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("h1") == F.col("_h1"))
                     & (F.col("h2") == F.col("_h2")), "left")
    dup = ~F.col("is_blank") & F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    cut_off = ~F.col("is_blank") & ~dup & ~F.col("is_ended")
    code = F.when(F.col("is_blank") | dup, "x").when(cut_off, F.upper("i")).otherwise(F.col("i"))
    row = F.struct("pos", code.alias("code"), "i")
    count = lambda c: F.sum(c.cast("long"))
    return (rows.withColumn("block", F.floor(F.col("pos") / block).cast("long"))
            .groupBy("conv_id", "block")
            .agg(F.array_sort(F.collect_list(row)).alias("rows"), F.ceil(F.max("n_rows") / block).cast("long").alias("n_blocks"),
                 F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.size(F.collect_set("turn")).cast("long").alias("n_turns"),
                 count(F.col("is_blank")).alias("blank"), count(dup).alias("duplicate"), count(cut_off).alias("truncated"))
            .withColumns({"codes": F.array_join("rows.code", ""), "initials": F.array_join("rows.i", "")}).drop("rows"))


def audits(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation that has rows."""
    blocks = cut(coded_blocks(placed, block).mapInArrow(_tables, _BLOCK_DDL), "repair-blocks")
    most = blocks.agg(F.max("n_blocks")).first()[0] or 0
    whole = blocks.filter("n_blocks = 1")
    while most > 1:
        part = F.floor(F.col("block") / FAN)
        blocks = cut(blocks.filter("n_blocks > 1").groupBy("conv_id", part.alias("part")).applyInArrow(_merged, _BLOCK_DDL), "repair-blocks")
        whole, most = whole.union(blocks.filter("n_blocks = 1")), -(-most // FAN)
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    return whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                        F.col("edits")[0]["cost"].alias("cost"), F.col("edits")[0]["audit"].alias("audit"))


# ---------------------------------------------------------------- the repaired conversation

class Repair:
    """Applies an audit to the rows of a conversation, one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            role = WANTED[self.state]
            self.state = AFTER[self.state, role]
            yield NAMES[role], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The turns that come out for a row: those inserted before it, and itself unless deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        i = role[:1] if edit == "K" else WANTED[self.state]
        self.state = AFTER[self.state, i]
        yield (role if edit == "K" else NAMES[i]), text


OUT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_OUT_SCHEMA = pa.schema([(c, pa.string() if c == "audit" else pa.int64()) for c in OUT] + [("repaired_sha256", pa.string())])
_OUT_DDL = ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in OUT) + ", repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, each led by the row of its audit -> digests of the repaired texts."""
    head, repair, sha, any_yet = None, None, None, False

    def put(turns: Iterator[tuple[str, str]]) -> None:
        nonlocal any_yet
        for role, text in turns:
            sha.update((("\n" if any_yet else "") + role + ":" + text).encode())
            any_yet = True

    def ended_with() -> dict:
        put(repair.inserted())
        return head | {"repaired_sha256": sha.hexdigest()}

    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in OUT]
        for k, (is_row, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("is_row", "role", "text")))):
            if is_row:
                put(repair.row(role, text))
                continue
            if head is not None:
                out.append(ended_with())
            head = {c: v[k] for c, v in zip(OUT, cols)}
            repair, sha, any_yet = Repair(head["audit"]), hashlib.sha256(), False
        yield pa.RecordBatch.from_pylist(out, schema=_OUT_SCHEMA)
    if head is not None:
        yield pa.RecordBatch.from_pylist([ended_with()], schema=_OUT_SCHEMA)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows -> the repaired turns."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    conv, repair, place = None, None, 0
    for batch in batches:
        out: list[tuple] = []

        def put(turns: Iterator[tuple[str, str]]) -> None:
            nonlocal place
            for role, text in turns:
                out.append((conv, place, role, text))
                place += 1
        for c, is_row, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text", "audit"))):
            if is_row:
                put(repair.row(role, text))
                continue
            if repair is not None:
                put(repair.inserted())
            conv, repair, place = c, Repair(audit), 0
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=schema)
    if repair is not None:
        rest = [(conv, place + k, *t) for k, t in enumerate(repair.inserted())]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in rest], schema=schema)


def _led(df: DataFrame, ids: DataFrame, block: int) -> DataFrame:
    """Rows of all conversations in order, each conversation led by a row with its audit and counts."""
    placed = placed_rows(df)
    told = audits(placed, block)
    told = told.select(F.col("conv_id").alias("_c"), *OUT[1:])
    heads = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(
        told, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    heads = heads.fillna(0, list(OUT[1:-1])).fillna("", ["audit"]).withColumns(
        {"is_row": F.lit(False), "pos": F.lit(0).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    rows = placed.select("conv_id", *[F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in OUT[1:]],
                         F.lit(True).alias("is_row"), "pos", "role", "text")
    return heads.select(rows.columns).union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "pos")


def repair_conversations(df: DataFrame, ids: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Faults, cheapest edits and the repaired text's digest of every conversation of
    ``ids`` (those of ``df``, by default)."""
    return _led(df, df if ids is None else ids, block).mapInArrow(_hashed, _OUT_DDL)


def repaired_turns(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, place (from 0), role, text: the repaired conversations themselves."""
    return _led(df, df, block).mapInArrow(_repaired, "conv_id long, place long, role string, text string")


def damaged(df: DataFrame) -> DataFrame:
    """``df`` with a fifth of its turns damaged, chosen by crc32 of ``conv_id:turn``; nulls become one space."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = df.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")


# ---------------------------------------------------------------- SQL

def _inserts(state: int) -> list[tuple[str, str, int, int]]:
    """(edits, lines, state after, cost) of up to two turns inserted; more never pay."""
    out, lines = [("", "", state, 0)], ""
    for k in (1, 2):
        role = WANTED[state]
        lines, state = lines + f"~{NAMES[role]}:", AFTER[state, role]
        out.append(("I" * k, lines, state, k * COST["I"]))
    return out


def _steps() -> str:
    rows = []
    for c in CODES:
        for s in range(STATES):
            for ins, lines, m, w in _inserts(s):
                for e, t, w2 in _ROWS[c, m]:
                    role = NAMES[WANTED[m]] if e == "R" else ""
                    rows.append(f"('{c}',{s},{t},{w + w2},'{ins}{e}','{lines}','{role}')")
    return ",".join(rows)


def _ends() -> str:
    return ",".join(f"({s},{w},'{ins}','{lines}')" for s in range(STATES) for ins, lines, t, w in _inserts(s) if t in DONE)


#: The same rows for DuckDB: a table of the cheapest edits by rows consumed and state.
SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS twin
      FROM k WHERE kind <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, twin) - 1 AS pos,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, twin) AS nth,
      CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS i FROM d),
q AS (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS prev,
      CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM p),
c AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(i) ELSE i END AS code FROM q),
step(code, s, t, cost, edits, lines, rerole) AS (VALUES {_steps()}),
fin(s, cost, edits, lines) AS (VALUES {_ends()}),
r AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS s,
             {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''}} AS b FROM c
      UNION ALL
      SELECT r.conv_id, r.pos + 1, step.t, min({{'cost': r.b.cost + step.cost, 'audit': r.b.audit || step.edits,
             'lines': r.b.lines || replace(step.lines, '~', chr(10)) || CASE right(step.edits, 1) WHEN 'D' THEN ''
             WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || rerole || ':' || text END}})
      FROM r JOIN c ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.pos = c.pos JOIN step ON step.code = c.code AND step.s = r.s
      GROUP BY r.conv_id, r.pos + 1, step.t),
stat AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || i NOT IN ('su', 'ua', 'au')) AS illegal FROM c GROUP BY conv_id),
best AS (SELECT r.conv_id, min({{'cost': r.b.cost + fin.cost, 'audit': r.b.audit || fin.edits,
         'lines': r.b.lines || replace(fin.lines, '~', chr(10))}}) AS b
         FROM r JOIN stat ON r.conv_id IS NOT DISTINCT FROM stat.conv_id AND r.pos = stat.n JOIN fin ON fin.s = r.s GROUP BY r.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(substr(b.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stat ON o.conv_id IS NOT DISTINCT FROM stat.conv_id
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
"""
