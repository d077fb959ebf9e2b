"""N-gram Jaccard join (operator 8).

Documents are sets of word n-grams. Two sets of similarity t or more share one
of their first n - ceil(t n) + 1 n-grams in any common order; with the rarest
first, those prefixes have few n-grams in common by chance. Rarity comes from a
counting sketch of fixed size over all documents. Documents are joined on prefix
n-grams, then cut by length, by the n-gram's places and by a bound on what the
suffixes can share; each pair left is verified once on the whole sets.

Equal sets are joined as one. A large group of near copies isn't expanded into
all pairs: first each document is verified with one other, the hub of most of
its prefix n-grams; then only pairs whose ends are not connected yet are joined,
each of them. So the components are those of all links.

Defined cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; a text of fewer words than n has one n-gram, the whole;
repeated rows are each reported; rows of one id count as one document; rows
without an id are reported without component; empty tables give an empty result;
columns besides the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import cut, documents, with_ids
from .components import components

N = 5
#: Similarity of 8 tenths: t = NUM / DEN.
NUM, DEN = 8, 10
#: Counters of the sketch, and the parts it is summed in. Its size doesn't depend on the data.
CELLS, SLICES = 1 << 20, 64
#: Prefix n-grams the sketch counts more often than this above the mean are taken
#: as repeated without a look at each other, so no task sorts all of one n-gram's rows.
HOT = 20_000
#: Documents compared with one hub in one go.
CHUNK = 256


# ---------------------------------------------------------------- sets of n-grams

def gram_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, row): each text's different n-grams, by row, then by value."""
    g, row, _ = tb.grams(*tb.word_hashes(data, offs), N, short=True)
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    return g[new], row[new]


def _reduced(ufunc: np.ufunc, x: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = ufunc.reduceat(x, (np.cumsum(n) - n)[full])
    return out


def _digests(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (_reduced(np.add, tb.mix(g), n).view(np.int64),
            _reduced(np.bitwise_xor, tb.mix(g + np.uint64(7)), n).view(np.int64))


def _bins(g: np.ndarray, row: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The set's sizes in eight ranges of hashes, up to 255 each, in one number."""
    by = np.bincount(row * 8 + (tb.mix(g) >> np.uint64(61)).astype(np.int64), minlength=8 * len(n))
    return np.minimum(by, 255).astype(np.uint8).reshape(len(n), 8).copy().view(np.int64).ravel()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, and the partition's counting sketch in slices."""
    sketch = np.zeros(CELLS, np.int64)
    names = ["doc_id", "n", "d1", "d2", "bins", "slice", "counts"]
    for batch in batches:
        for at, data, offs in tb.chunks(batch.column(1)):
            g, row = gram_sets(data, offs)
            size = len(offs) - 1
            n = np.bincount(row, minlength=size)
            sketch += np.bincount((g >> np.uint64(44)).astype(np.int64), minlength=CELLS)
            d1, d2 = _digests(g, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, size), pa.array(n), pa.array(d1), pa.array(d2),
                 pa.array(_bins(g, row, n)), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], names=names)
    if sketch.any():
        own = np.minimum(sketch, 2 ** 32 - 1).astype("<u4").reshape(SLICES, -1)
        none = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none] * 5 + [pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in own], pa.binary())],
            names=names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(b, "<u4").astype(np.int64)
            total[k] = total[k] + x if k in total else x
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()),
         pa.array([np.minimum(x, 2 ** 32 - 1).astype("<u4").tobytes() for x in total.values()], pa.binary())],
        names=["slice", "counts"])


def _prefixes(sketch: np.ndarray):
    hot_at = HOT + 2 * float(sketch.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offs in tb.chunks(batch.column(1)):
                g, row = gram_sets(data, offs)
                size = len(offs) - 1
                n = np.bincount(row, minlength=size)
                d1, d2 = _digests(g, n)
                often = sketch[(g >> np.uint64(44)).astype(np.int64)]
                order = np.lexsort((g, often, row))
                rank = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
                length = np.where(n > 0, n - (NUM * n + DEN - 1) // DEN + 1, 0)
                kept = rank < length[row]
                cold = np.bincount(row[kept & (often[order] < hot_at)], minlength=size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, size), pa.array(n), pa.array(d1), pa.array(d2), pa.array(cold),
                     pa.ListArray.from_arrays(np.append(0, np.cumsum(length)).astype(np.int32),
                                              pa.array(g[order][kept].view(np.int64)))],
                    names=["doc_id", "n", "d1", "d2", "cold", "prefix"])
    return run


# ---------------------------------------------------------------- filters

def least_shared(a: Column, b: Column) -> Column:
    """Shared n-grams that sets of these sizes need: ceil(t (a + b) / (1 + t))."""
    return F.floor((NUM * (a + b) + (NUM + DEN - 1)) / (NUM + DEN))


def sizes_fit(a: Column, b: Column) -> Column:
    return (DEN * F.least(a, b)) >= (NUM * F.greatest(a, b))


def places_fit(a: Column, pa_: Column, b: Column, pb: Column) -> Column:
    """From these places on, the sets still have enough n-grams to share."""
    return F.least(a - pa_, b - pb) >= least_shared(a, b)


def suffixes_fit(a: Column, bins_a: Column, b: Column, bins_b: Column) -> Column:
    """The sizes in eight ranges of hashes differ by no more than the sets may."""
    apart = None
    for k in range(8):
        x = F.abs(F.shiftrightunsigned(bins_a, 8 * k).bitwiseAND(F.lit(255))
                  - F.shiftrightunsigned(bins_b, 8 * k).bitwiseAND(F.lit(255)))
        apart = x if apart is None else apart + x
    return apart <= a + b - 2 * least_shared(a, b)


# ---------------------------------------------------------------- verification

def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (y, chunk, x, head, text) in order, each hub first in its chunk: the pairs that are linked."""
    hub, hub_set = None, np.zeros(0, np.uint64)
    for batch in batches:
        ys, cs, xs, heads = (batch.column(i).to_pylist() for i in range(4))
        out_x: list[int] = []
        out_y: list[int] = []
        for at, data, offs in tb.chunks(batch.column(4)):
            g, row = gram_sets(data, offs)
            cuts = np.searchsorted(row, np.arange(len(offs)))
            for i in range(len(offs) - 1):
                own, k = g[cuts[i]:cuts[i + 1]], at + i
                if heads[k]:
                    # several texts of one id are several sets of one hub
                    hub_set = [*hub_set, own] if hub == (ys[k], cs[k]) else [own]
                    hub = (ys[k], cs[k])
                elif hub == (ys[k], cs[k]) and any(_linked(own, h) for h in hub_set):
                    out_x.append(xs[k])
                    out_y.append(ys[k])
        yield pa.RecordBatch.from_arrays([pa.array(out_x, pa.int64()), pa.array(out_y, pa.int64())], names=["a", "b"])


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    if not len(x) or not len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    shared = int((y[at] == x).sum())
    return DEN * shared >= NUM * (len(x) + len(y) - shared)


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) that are similar, as (a, b). A hub's partners come in chunks."""
    size = pairs.groupBy("y").agg(F.count("*").alias("of_y"))
    split = pairs.join(size, "y").select(
        "x", "y", F.pmod(F.xxhash64("x"), F.floor(F.col("of_y") / CHUNK) + 1).alias("chunk"))
    t = texts.select(F.col("doc_id").alias("x"), "text")
    body = split.join(t, "x").select("y", "chunk", "x", F.lit(False).alias("head"), "text")
    heads = (split.select("y", "chunk").distinct().withColumn("x", F.col("y")).join(t, "x")
             .select("y", "chunk", "x", F.lit(True).alias("head"), "text"))
    return (body.union(heads).repartition("y", "chunk").sortWithinPartitions("y", "chunk", F.desc("head"))
            .mapInArrow(_compare, "a long, b long"))


# ---------------------------------------------------------------- the join

def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``df``."""
    docs = documents(df, id_col, text_col)
    seen = cut(docs.mapInArrow(_describe, "doc_id long, n long, d1 long, d2 long, bins long, "
                                          "slice int, counts binary"), "jaccard-sets")
    rows = seen.filter("slice IS NULL").select("doc_id", "n", "d1", "d2", "bins")
    sketch = np.zeros((SLICES, CELLS // SLICES), np.uint32)
    for r in (seen.filter("slice IS NOT NULL").select("slice", "counts").repartition("slice")
              .mapInArrow(_summed, "slice int, counts binary").collect()):
        sketch[r.slice] = np.frombuffer(r.counts, "<u4")

    # one document per different set
    sets = cut(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2")
               .agg(F.min("doc_id").alias("rep"), F.max("bins").alias("bins")), "jaccard-classes")
    reps = sets.select(F.col("rep").alias("doc_id"), "d1", "d2")
    of_row = cut(rows.join(sets.drop("bins"), ["n", "d1", "d2"], "left").select("doc_id", "n", "rep"), "jaccard-rows")
    # an id with several texts connects their sets
    several_texts = (of_row.filter(F.col("rep").isNotNull()).groupBy("doc_id")
                     .agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.collect_set("rep").alias("reps"))
                     .filter("a <> z").select("a", F.explode("reps").alias("b")).filter("a <> b"))
    entry = (docs.mapInArrow(_prefixes(sketch.ravel()), "doc_id long, n long, d1 long, d2 long, cold long, "
                                                        "prefix array<long>")
             .join(reps, ["doc_id", "d1", "d2"], "left_semi")
             .select("doc_id", "n", "cold", F.posexplode("prefix").alias("place", "gram")))
    cold = (entry.filter("place < cold").select("gram", "doc_id", "n", "place")
            .withColumn("c", F.count("*").over(Window.partitionBy("gram"))).filter("c > 1").drop("c"))
    hot = entry.filter("place >= cold").select("gram", "doc_id", "n", "place")
    shared = cut(cold.union(hot).dropDuplicates(["gram", "doc_id"]), "jaccard-prefixes")

    bins = sets.select(F.col("rep").alias("id"), "bins").groupBy("id").agg(F.max("bins").alias("bins"),
                                                                          F.count("*").alias("texts"))

    def cut_down(pairs: DataFrame) -> DataFrame:
        bx = bins.select(F.col("id").alias("x"), F.col("bins").alias("bx"), F.col("texts").alias("tx"))
        by = bins.select(F.col("id").alias("y"), F.col("bins").alias("by"), F.col("texts").alias("ty"))
        several = (F.col("tx") > 1) | (F.col("ty") > 1)
        return (pairs.join(bx, "x").join(by, "y")
                .filter(several | suffixes_fit(F.col("nx"), F.col("bx"), F.col("ny"), F.col("by"))))

    # each document with the hub of most of its prefix n-grams
    hubs = (shared.groupBy("gram").agg(F.min(F.struct("place", "doc_id", "n")).alias("h"))
            .select("gram", F.col("h.doc_id").alias("y"), F.col("h.n").alias("ny"), F.col("h.place").alias("py")))
    with_hub = (shared.join(hubs, "gram").filter(F.col("doc_id") != F.col("y"))
                .filter(sizes_fit(F.col("n"), F.col("ny"))
                        & places_fit(F.col("n"), F.col("place"), F.col("ny"), F.col("py")))
                .groupBy(F.col("doc_id").alias("x"), "y").agg(F.count("*").alias("grams"), F.max("n").alias("nx"),
                                                             F.max("ny").alias("ny")))
    one = (cut_down(with_hub).groupBy("x").agg(F.max_by("y", F.struct("grams", -F.col("y"))).alias("y")))
    one = cut(one, "jaccard-hubs")
    ids = one.select(F.col("x").alias("doc_id")).union(one.select(F.col("y").alias("doc_id"))).distinct()
    texts = cut(with_ids(docs, cut(ids, "jaccard-ids")), "jaccard-texts")
    comp = components(cut(linked(one, texts).union(several_texts), "jaccard-links"))

    # then all pairs of ends that are still apart
    apart = (shared.join(comp, shared.doc_id == comp.id, "left")
             .select("gram", "doc_id", "n", "place", F.coalesce("component", "doc_id").alias("c")))
    several = (apart.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
               .filter("lo <> hi").select("gram"))
    apart = cut(apart.join(several, "gram", "left_semi"), "jaccard-apart")
    # documents alike in component, size and place pass the filters together: pairs of such
    # groups are filtered first, and only what is left is dealt out into documents
    px = apart.select("gram", F.col("c").alias("cx"), F.col("n").alias("nx"), F.col("place").alias("px"),
                      F.col("doc_id").alias("x"))
    py = apart.select("gram", F.col("c").alias("cy"), F.col("n").alias("ny"), F.col("place").alias("py"),
                      F.col("doc_id").alias("y"))
    fits = ((F.col("cx") < F.col("cy")) & sizes_fit(F.col("nx"), F.col("ny"))
            & places_fit(F.col("nx"), F.col("px"), F.col("ny"), F.col("py")))
    gx, gy = px.drop("x").distinct(), py.drop("y").distinct()
    twos = cut(gx.join(gy, (gx.gram == gy.gram) & fits)
               .select(gx.gram, "cx", "nx", "px", "cy", "ny", "py"), "jaccard-groups")
    more = (twos.join(px, ["gram", "cx", "nx", "px"]).join(py, ["gram", "cy", "ny", "py"])
            .select("x", "y", "nx", "ny", "cx", "cy").distinct())
    done = one.select("x", "y").union(one.select(F.col("y").alias("x"), F.col("x").alias("y")))
    more = cut(cut_down(more).join(done, ["x", "y"], "left_anti").select("x", "y", "cx", "cy"), "jaccard-apart-pairs")
    ids = more.select(F.col("x").alias("doc_id")).union(more.select(F.col("y").alias("doc_id"))).distinct()
    texts = cut(with_ids(docs, cut(ids, "jaccard-ids")), "jaccard-texts")
    late = (linked(more.select("x", "y"), texts).join(more, [F.col("a") == F.col("x"), F.col("b") == F.col("y")])
            .select(F.col("cx").alias("a"), F.col("cy").alias("b")))
    joined = components(late).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    final = (comp.join(joined, "component", "full")
             .select(F.coalesce("id", "component").alias("rep"), F.coalesce("whole", "component").alias("least")))

    return (of_row.join(final, "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "rep", "doc_id")).alias("component_id")))


#: The same rows for DuckDB, by all n-grams of all documents.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r AS (SELECT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, coalesce((SELECT min(r.y) FROM r WHERE r.x = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""
