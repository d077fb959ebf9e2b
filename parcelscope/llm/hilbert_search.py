"""Approximate nearest neighbours by shifted space-filling curves (operator 6).

Vectors are projected to a few dimensions in several random, shifted ways. Each
projection orders them along a Hilbert curve; Spark range-partitions and sorts
by (curve, place). A query is compared with the candidates whose ranks on some
curve are within a window of its own; the curves' best are merged and reranked.

Nearness is the inner product, so candidates get one more component that lifts
all to the largest norm, and queries are scaled to it: along the curves, near
then means large inner product. The number of curves and the window are those
of least work that find ``RECALL`` of the true neighbours of a bounded sample of
queries, whose truth one exact pass over all rows gives. Equal vectors are
searched for once.

Queries are compared in chunks, as they follow each other on a curve, with
blocks of the candidates within the chunk's windows. Chunks and blocks are packed
into one row each before they meet; a task's group holds at most ``CHUNK`` queries
and ``BLOCK * GROUP`` candidates, whatever the window.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part; vectors of different lengths are searched each among
their own; rows with equal id and vector count as copies; a null id takes no
part; with fewer than ``k`` candidates all are returned; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, cut

K = 20
CURVES = 24
#: Numbers of curves to choose from.
CURVE_CHOICES = (3, 4, 6, 8, 12, 16, 24)
DIMS, BITS = 8, 4
#: Candidates of a packed block, blocks and queries compared at once: the bounds of a task's group.
BLOCK, GROUP, CHUNK = 2048, 4, 512
#: Bounded samples: vectors that scale the grid, queries that set curves and window.
SCALE_SAMPLE, QUERY_SAMPLE = 4_000, 128
RECALL = 0.97
LEAST_WINDOW = 64


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows of integers below 2^bits).

    Gray-code form: from the highest bit down, each axis either flips or swaps
    the lower bits of the first axis; a prefix of exclusive-ors and one
    correction follow, then the bits of all axes are interleaved.
    """
    x = cells.T.astype(np.int64).copy()
    for shift in range(bits - 1, 0, -1):
        bit, low = 1 << shift, (1 << shift) - 1
        for axis in range(len(x)):
            flip = (x[axis] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    fix = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] >> shift) & 1, (1 << shift) - 1, 0)
    x ^= fix
    out = np.zeros(x.shape[1], np.int64)
    for shift in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            out = (out << 1) | ((x[axis] >> shift) & 1)
    return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dim)


class Curves:
    """The projections, with the grid's scale from a bounded sample of vectors."""

    def __init__(self, dim: int, top: float, sample: np.ndarray, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.dim, self.top = dim, top
        dims = min(DIMS, dim + 1)
        self.maps = [np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0][:, :dims] for _ in range(CURVES)]
        self.shifts = rng.uniform(-0.5, 0.5, (CURVES, dims))
        lifted = self.lift(sample)
        self.scales = [((lifted @ m).mean(0), (lifted @ m).std(0) + 1e-12) for m in self.maps]

    def lift(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top ** 2 - (v * v).sum(1), 0))
        return np.hstack([v, rest[:, None]])

    def scaled(self, v: np.ndarray) -> np.ndarray:
        v = v * (self.top / np.maximum(np.linalg.norm(v, axis=1), 1e-300))[:, None]
        return np.hstack([v, np.zeros((len(v), 1))])

    def places(self, points: np.ndarray, curve: int) -> np.ndarray:
        mean, sd = self.scales[curve]
        z = (points @ self.maps[curve] - mean) / sd + self.shifts[curve]
        side = 1 << BITS
        return hilbert_place(np.clip(((z + 3) / 6 * side).astype(np.int64), 0, side - 1), BITS)


def _places(curves: Curves, query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1), curves.dim)
            points = curves.scaled(v) if query else curves.lift(v)
            for c in range(CURVES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), c, np.int32)), pa.array(curves.places(points, c)),
                     pa.array(np.full(len(v), int(query), np.int32)), batch.column(0)],
                    names=["curve", "place", "query", "id"])
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the numbers of candidates and queries so far on the curve in it."""
    part, before, last = TaskContext.get().partitionId(), np.zeros(2, np.int64), None
    for batch in batches:
        curve = batch.column(0).to_numpy()
        if not len(curve):
            continue
        is_query = batch.column(2).to_numpy().astype(np.int64)
        kinds = np.stack([1 - is_query, is_query])
        earlier = np.cumsum(kinds, axis=1) - kinds
        first = np.flatnonzero(np.append(True, curve[1:] != curve[:-1]))
        at = earlier - np.repeat(earlier[:, first], np.diff(np.append(first, len(curve))), axis=1)
        at += np.where(curve == last, before[:, None], 0)
        before, last = at[:, -1] + kinds[:, -1], int(curve[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3),
             pa.array(np.full(len(curve), part, np.int32)), pa.array(at[0]), pa.array(at[1])],
            names=["curve", "query", "id", "part", "at", "at_query"])


def ranked(cands: DataFrame, queries: DataFrame, curves: Curves) -> DataFrame:
    """(curve, query, id, rank, turn): candidates and queries before each row on each curve."""
    ddl = "curve int, place long, query int, id long"
    rows = cands.mapInArrow(_places(curves, False), ddl).union(queries.mapInArrow(_places(curves, True), ddl))
    at = cut(rows.repartitionByRange("curve", "place", "query", "id")
             .sortWithinPartitions("curve", "place", "query", "id")
             .mapInArrow(_counted, "curve int, query int, id long, part int, at long, at_query long"), "hilbert-ranks")
    # one row per partition and curve
    sizes = at.groupBy("curve", "part").agg(F.sum(1 - F.col("query")).alias("n"), F.sum("query").alias("n_query"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("curve", "part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"skip_{n}") for n in ("n", "n_query")])
    return at.join(sizes, ["curve", "part"]).select(
        "curve", "query", "id", (F.col("at") + F.col("skip_n")).alias("rank"), (F.col("at_query") + F.col("skip_n_query")).alias("turn"))


def _nearest(queries: np.ndarray, ids: np.ndarray, k: int):
    """Per batch, the best k rows for each of a bounded set of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                s = queries @ matrix(batch.column(1), queries.shape[1]).T
                yield _best(ids, batch.column(0).to_numpy(), s, k)
    return run


def _best(qids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> pa.RecordBatch:
    """Each query's k best rows, ties to smaller ids."""
    k = min(k, len(ids))
    least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
    # all rows as good as the k-th best: few more than k a query
    q, c = np.nonzero(scores >= least[:, None])
    order = np.lexsort((ids[c], -scores[q, c], q))
    q, c = q[order], c[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    q, c = q[keep], c[keep]
    return pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(ids[c]), pa.array(scores[q, c])],
                                      names=["query_id", "id", "score"])


FOUND = "query_id long, id long, score double"


def least_work(far: np.ndarray, n: int, n_query: int) -> tuple[int, int]:
    """Curves and window of least work that find RECALL of the pairs of a sample.

    ``far``: for each pair of a query and a true neighbour its distance in ranks on
    each curve. The work of a query on a curve is the candidates of its chunk's
    windows, which end at the curve's ends.
    """
    best = None
    for m in CURVE_CHOICES:
        near = np.sort(far[:, :m].min(axis=1))
        w = max(LEAST_WINDOW, int(near[min(len(near) - 1, int(np.ceil(RECALL * len(near))))]) + 1)
        span = 2 * w - w * w / n if w < n else n
        work = m * min(n, span + CHUNK * n / max(n_query, 1))
        if best is None or work < best[0]:
            best = work, m, w
    return best[1:]


def _window(cands: DataFrame, queries: DataFrame, ranks: DataFrame, n: int, dim: int, k: int) -> tuple[int, int]:
    """Curves and window, from the true neighbours of a bounded sample of queries."""
    sample = bounded_sample(queries, "id", QUERY_SAMPLE).toArrow()
    if n <= 2 * LEAST_WINDOW or not len(sample):
        return CURVE_CHOICES[0], n
    qids = sample.column("id").to_numpy()
    truth = (cands.mapInArrow(_nearest(matrix(sample.column("v").combine_chunks(), dim), qids, k + 1), FOUND)
             .filter(F.col("query_id") != F.col("id"))
             .withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
             .filter(F.col("r") <= k).select("query_id", "id"))
    truth = cut(truth, "hilbert-truth")
    of_q = ranks.filter("query = 1").select("curve", F.col("id").alias("query_id"), F.col("rank").alias("q"))
    of_c = ranks.filter("query = 0").select("curve", "id", "rank")
    # a row a curve of the sample's pairs
    got = (truth.join(of_c, "id").join(of_q, ["curve", "query_id"])
           .select("query_id", "id", "curve", F.abs(F.col("rank") - F.col("q")).alias("far"))
           .orderBy("query_id", "id", "curve").toArrow())
    far = got.column("far").to_numpy().reshape(-1, CURVES)
    if not len(far):
        return CURVE_CHOICES[0], n
    return least_work(far, n, queries.count())


def _packed(name: str, dim: int, dtype: str):
    """One row of a block or chunk: its ids and vectors in the order of their ranks."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rank = rows.column("rank").to_numpy()
        order = np.argsort(rank, kind="stable")
        ids = rows.column("id").to_numpy()[order].astype("<i8")
        v = matrix(rows.column("v").combine_chunks(), dim)[order].astype(dtype)
        return pa.table({"curve": pa.array([key[0].as_py()], pa.int32()), name: pa.array([key[1].as_py()], pa.int64()),
                         "first": pa.array([rank.min()], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "v": pa.array([v.tobytes()], pa.binary())})
    return run


def _compare(dim: int, dtype: str, k: int):
    """The best of a chunk's queries among a few blocks, cut to the chunk's windows."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        queries, ids, vectors = None, [], []
        for r in rows.to_pylist():
            own = np.frombuffer(r["ids"], "<i8")
            v = np.frombuffer(r["v"], dtype).reshape(len(own), dim).astype(np.float64)
            if r["query"]:
                queries = own, v
            else:
                part = slice(max(0, r["lo"] - r["first"]), max(0, r["hi"] - r["first"] + 1))
                ids.append(own[part])
                vectors.append(v[part])
        ids, vectors = np.concatenate(ids), np.concatenate(vectors)
        return pa.Table.from_batches([_best(queries[0], ids, queries[1] @ vectors.T, k + 1)])
    return run


def _search(vectors: DataFrame, n: int, top: float, dim: int, k: int) -> DataFrame:
    """(query_id, id, score): the best k distinct vectors of each query vector, and itself."""
    cands = vectors.select("id", "v")
    queries = vectors.filter("asked").select("id", "v")
    scale = bounded_sample(cands, "id", SCALE_SAMPLE).toArrow().column("v").combine_chunks()
    ranks = cut(ranked(cands, queries, Curves(dim, top, matrix(scale, dim))), "hilbert-rows")
    curves, w = _window(cands, queries, ranks, n, dim, k)
    ranks = ranks.filter(F.col("curve") < curves)
    c_rows = ranks.filter("query = 0").select("curve", "id", "query", "rank", F.floor(F.col("rank") / BLOCK).alias("block"))
    q_rows = ranks.filter("query = 1").select("curve", "id", "query", "rank", F.floor(F.col("turn") / CHUNK).alias("chunk"))
    dtype = "<f4" if vectors.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    whole = "curve int, {} long, first long, ids binary, v binary"
    blocks = c_rows.join(cands, "id").groupBy("curve", "block").applyInArrow(_packed("block", dim, dtype), whole.format("block"))
    packed = q_rows.join(queries, "id").groupBy("curve", "chunk").applyInArrow(_packed("chunk", dim, dtype), whole.format("chunk"))
    # the candidates within the windows of each chunk, and the blocks that hold them
    spans = (q_rows.groupBy("curve", "chunk").agg(F.greatest(F.min("rank") - w, F.lit(0)).alias("lo"),
                                                  F.least(F.max("rank") + w, F.lit(n - 1)).alias("hi")))

    def over(size: int) -> Column:
        return F.explode(F.sequence(F.floor(F.col("lo") / size), F.floor(F.col("hi") / size)))
    columns = ["curve", "chunk", "group", "query", "first", "lo", "hi", "ids", "v"]
    of_c = (blocks.join(spans.withColumn("block", over(BLOCK)), ["curve", "block"])
            .withColumn("group", F.floor(F.col("block") / GROUP)).withColumn("query", F.lit(0)).select(columns))
    of_q = (packed.join(spans.withColumn("group", over(BLOCK * GROUP)), ["curve", "chunk"])
            .withColumn("query", F.lit(1)).select(columns))
    found = (of_c.unionByName(of_q).groupBy("curve", "chunk", "group").applyInArrow(_compare(dim, dtype, k), FOUND)
             .groupBy("query_id", "id").agg(F.max("score").alias("score")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")


def usable(df: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, h, asked) of the rows that take part; h identifies equal vectors."""
    kind = df.schema[vec_col].dataType.elementType.simpleString()
    good = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    # 0.0 and -0.0 are the same component
    return (good.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind)))
            .select("id", "v", F.struct(F.xxhash64("v"), F.xxhash64(F.lit(1), "v")).alias("h"),
                    is_query.alias("asked")))


def members_of(good: DataFrame, k: int) -> DataFrame:
    """(h, members): the k + 1 smallest ids of each vector; no more can be among the
    k nearest of a query. Large groups are cut down in 64 parts first."""
    part = Window.partitionBy("h", "salt").orderBy("id")
    few = (good.select("h", "id").distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
           .withColumn("r", F.row_number().over(part)).filter(F.col("r") <= k + 1))
    return few.groupBy("h").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("members"))


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``k`` nearest other rows.

    ``is_query`` is a condition on a column ``id``. Queries with equal vectors
    share one search and differ in leaving out themselves only.
    """
    good = usable(df, is_query, id_col, vec_col)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    vectors = cut(good.groupBy("h").agg(F.min("id").alias("id"), F.first("v").alias("v"),
                                        F.max("asked").alias("asked"))
                  .join(members_of(good, k), "h")
                  .select("h", "id", "v", "asked", "members", F.size("v").alias("dim"), norm.alias("norm")),
                  "hilbert-vectors")
    found = None
    for s in vectors.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy("dim").collect():
        part = _search(vectors.filter(F.col("dim") == s.dim), s.n, s.top, s.dim, k)
        found = part if found is None else found.union(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], FOUND)
    # the k + 1 best ids of each query vector, once for all queries that have it
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ids = (found.join(vectors.select("id", "members"), "id")
           .select("query_id", "score", F.explode("members").alias("vec_id"))
           .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r"))
    asked = (good.filter("asked").select(F.col("id").alias("own"), "h").distinct()
             .join(vectors.select("h", F.col("id").alias("query_id")), "h").select("own", "query_id"))
    last = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id")
    return (asked.join(ids, "query_id").filter(F.col("own") != F.col("vec_id"))
            .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select(F.col("own").alias("query_id"), "rank", "vec_id", "score"))
