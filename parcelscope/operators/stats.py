"""Scaling and curve fitting (M1, M4-M7).

Fits are grouped aggregates: one row of sufficient statistics per group, so
the work is a partial aggregate over the data and the results are tiny. NULL is a
group like others.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.operators.reshape import unpivot


# ---------------------------------------------------------------- M1 z-score

def zscore_params(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and *population* std of each feature (one aggregate row).

    A constant (or empty) column gets scale 1, so it maps to 0, as
    scikit-learn's StandardScaler does. The result holds 2 numbers per
    feature, independent of the row count.
    """
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m_{f}"),
                 F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}")]
    row = df.agg(*aggs).first()
    out = {}
    for f in features:
        m = row[f"m_{f}"] or 0.0
        s = row[f"s_{f}"]
        out[f] = (m, s if s else 1.0)
    return out


def zscore(df: DataFrame, features: list[str], keep: list[str] | None = None,
           params: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """M1: ``(x - mean) / std_pop`` per feature; other columns in ``keep`` pass."""
    params = params or zscore_params(df, features)
    keep = keep if keep is not None else [c for c in df.columns if c not in features]
    cols = [((F.col(f).cast("double") - F.lit(params[f][0])) / F.lit(params[f][1])).alias(f)
            for f in features]
    return df.select(*keep, *cols)


# ------------------------------------------------------------- M4 linear fit

def linear_fit(df: DataFrame, group_by: list[str], x: str, y: str) -> DataFrame:
    """M4: least-squares line y ~ x per group, with correlation and R^2."""
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(yc, xc).alias("slope"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.corr(xc, yc).alias("corr"),
        F.regr_r2(yc, xc).alias("r2"))


# ------------------------------------------------------ M5 polynomial fits

#: Partial rows of a task are merged whenever so many have come together.
_MERGE_ROWS = 20_000
#: Tasks that share the first merge of a group's partial rows.
_SALTS = 64


def _moment_schema(keys: pa.Schema) -> pa.Schema:
    lists = pa.list_(pa.float64())
    return pa.schema([*keys, ("xmin", pa.float64()), ("xmax", pa.float64()), ("y0", pa.float64()), ("yy", pa.float64()),
                      ("m", lists), ("b", lists), ("xs", lists)])


def _group_codes(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's group, NULL being a value like others, and the first row of each group."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in keys:
        col = batch.column(k)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        index = pc.dictionary_encode(col, null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, code = np.unique(code * (index.max(initial=0) + 1) + index, return_inverse=True)
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return code, first


def _basis(xmin: np.ndarray, xmax: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and half width of a range: within it, t = (x - centre) / width lies in -1..1."""
    half = (xmax - xmin) / 2
    return xmin + half, np.where(half > 0, half, 1.0)


def _least_distinct(code: np.ndarray, x: np.ndarray, most: int) -> pa.Array:
    """The ``most`` smallest different values of each group, as lists."""
    order = np.lexsort((x, code))
    code, x = code[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (code[1:] != code[:-1]) | (x[1:] != x[:-1])
    code, x = code[new], x[new]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    place = np.arange(len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)]))
    code, x = code[place < most], x[place < most]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(code))], pa.int32()), pa.array(x))


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _summed(code: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums by group; every group has a row."""
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0])
    return np.add.reduceat(values[order], starts)


def _ends(code: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    xmin, xmax = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(xmin, code, lo)
    np.maximum.at(xmax, code, hi)
    return xmin, xmax


def _moment_table(keys: pa.Table, xmin, xmax, y0, yy, m, b, xs) -> pa.Table:
    cols = {**{k: keys.column(k) for k in keys.column_names}, "xmin": pa.array(xmin), "xmax": pa.array(xmax),
            "y0": pa.array(y0), "yy": pa.array(yy), "m": _lists(m), "b": _lists(b), "xs": xs}
    return pa.table(cols, schema=_moment_schema(keys.schema))


def _batch_moments(batch: pa.RecordBatch, keys: list[str], degree: int) -> pa.Table:
    """One row per group of a batch: range of x, mean of y, and the sums of t^k,
    (y - mean) t^k and (y - mean)^2."""
    x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    code, first = _group_codes(batch, keys)
    xmin, xmax = _ends(code, x, x, len(first))
    centre, half = _basis(xmin, xmax)
    t = (x - centre[code]) / half[code]
    powers = t[:, None] ** np.arange(2 * degree + 1)
    m = _summed(code, powers)
    y0 = _summed(code, y) / m[:, 0]
    u = y - y0[code]
    return _moment_table(pa.Table.from_batches([batch]).select(keys).take(pa.array(first)), xmin, xmax, y0, _summed(code, u * u),
                         m, _summed(code, u[:, None] * powers[:, :degree + 1]), _least_distinct(code, x, degree + 1))


def _merged_moments(rows: pa.Table, keys: list[str], degree: int) -> pa.Table:
    """The same for the union of the rows of each group.

    A group's rows are brought to the range and mean of the whole first. As the
    range only widens, t of a part is a + b t' with |a| + b <= 1, so nothing cancels.
    """
    code, first = _group_codes(rows, keys)
    n = len(first)
    lo, hi, y0, yy = (rows.column(c).to_numpy() for c in ("xmin", "xmax", "y0", "yy"))
    m = np.asarray(rows.column("m").combine_chunks().flatten()).reshape(-1, 2 * degree + 1)
    b = np.asarray(rows.column("b").combine_chunks().flatten()).reshape(-1, degree + 1)
    xmin, xmax = _ends(code, lo, hi, n)
    centre, half = _basis(xmin, xmax)
    own_centre, own_half = _basis(lo, hi)
    shift = ((own_centre - centre[code]) / half[code])[:, None]
    shrink = np.where(hi > lo, own_half / half[code], 0.0)[:, None]
    count = _summed(code, m[:, 0])
    mean = _summed(code, m[:, 0] * y0) / count
    up = (y0 - mean[code])[:, None]
    yy = yy + (2 * up * b[:, :1] + up * up * m[:, :1])[:, 0]
    b = b + up * m[:, :degree + 1]

    def moved(sums: np.ndarray) -> np.ndarray:
        return np.stack([sum(comb(k, j) * shift[:, 0] ** (k - j) * shrink[:, 0] ** j * sums[:, j] for j in range(k + 1))
                         for k in range(sums.shape[1])], axis=1)
    sizes = rows.column("xs").combine_chunks().value_lengths().to_numpy()
    xs = np.asarray(rows.column("xs").combine_chunks().flatten())
    return _moment_table(rows.select(keys).take(pa.array(first)), xmin, xmax, mean, _summed(code, yy), _summed(code, moved(m)),
                         _summed(code, moved(b)), _least_distinct(np.repeat(code, sizes), xs, degree + 1))


def _merging(keys: list[str], degree: int, raw: bool):
    """mapInArrow body: the partial rows of a task, merged as they come in."""
    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                held.append(_batch_moments(batch, keys, degree) if raw
                            else pa.Table.from_batches([batch]).drop_columns(["salt"]))
            if sum(h.num_rows for h in held) > _MERGE_ROWS:
                whole = _merged_moments(pa.concat_tables(held), keys, degree)
                held = [whole]
                if whole.num_rows > _MERGE_ROWS // 2:  # many groups: merging here doesn't help
                    yield from whole.to_batches()
                    held = []
        if held:
            yield from _merged_moments(pa.concat_tables(held), keys, degree).to_batches()
    return run


def _solved(rows: pa.Table, keys: list[str], degree: int) -> pa.Table:
    """The fits of merged rows, from their normal equations."""
    m, b = (np.asarray(rows.column(c).combine_chunks().flatten()).reshape(rows.num_rows, -1) for c in ("m", "b"))
    y0, yy, xmin, xmax = (rows.column(c).to_numpy() for c in ("y0", "yy", "xmin", "xmax"))
    gram = m[:, np.add.outer(np.arange(degree + 1), np.arange(degree + 1))]
    coef = np.zeros((rows.num_rows, degree, degree + 1))
    sse = np.zeros((rows.num_rows, degree))
    for d in range(1, degree + 1):
        g, r = gram[:, :d + 1, :d + 1], b[:, :d + 1]
        c = np.einsum("nij,nj->ni", np.linalg.pinv(g, rcond=1e-14, hermitian=True), r)
        sse[:, d - 1] = np.maximum(yy - 2 * (c * r).sum(1) + np.einsum("ni,nij,nj->n", c, g, c), 0)
        coef[:, d - 1, :d + 1] = c
        coef[:, d - 1, 0] += y0
    centre, half = _basis(xmin, xmax)
    out = {k: rows.column(k) for k in keys}
    return pa.table(out | {"n": m[:, 0], "m": pc.list_value_length(rows.column("xs")).cast(pa.int64()), "xmin": xmin, "xmax": xmax,
                           "centre": centre, "half": half, "sse": _lists(sse),
                           "coef": pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * degree, pa.int32()),
                                                            _lists(coef.reshape(-1, degree + 1)))})


def _solving(keys: list[str], degree: int):
    """mapInArrow body over rows sorted by group: only the last group of a batch can go on in the next."""
    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            whole = _merged_moments(rows if held is None else pa.concat_tables([held, rows]), keys, degree)
            code, _ = _group_codes(pa.concat_tables([rows.slice(rows.num_rows - 1).select(keys), whole.select(keys)]), keys)
            held = whole.filter(pa.array(code[1:] == code[0]))
            yield from _solved(whole.filter(pa.array(code[1:] != code[0])), keys, degree).to_batches()
        if held is not None:
            yield from _solved(held, keys, degree).to_batches()
    return run


def poly_fit(df: DataFrame, group_by: list[str], x: str, y: str, max_degree: int = 4) -> DataFrame:
    """Least-squares polynomials of degrees 1..max_degree, per group.

    One scan and no join: every task sums, per group, the powers of t (x brought to
    -1..1 by the range it has seen) and their products with y, Arrow batch by Arrow
    batch. Such rows of any parts of a group can be merged, whatever their ranges.
    They are merged in two steps, the first one salted, so a group that all tasks
    hold is spread; each group is then solved once, from rows sorted by group. A
    NULL group is a group.

    One row per group: n, m (distinct x, counted up to max_degree + 1), xmin, xmax,
    centre and half (t = (x - centre) / half), sse and coef (in powers of t) by degree.
    """
    g = list(group_by)
    rows = (df.select(*g, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
            .filter(F.col("x").isNotNull() & F.col("y").isNotNull()))
    sums = T.StructType(rows.select(*g).schema.fields + [T.StructField(c, T.DoubleType()) for c in ("xmin", "xmax", "y0", "yy")]
                        + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("m", "b", "xs")])
    part = rows.mapInArrow(_merging(g, max_degree, True), sums).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    part = part.repartition(*g, "salt").mapInArrow(_merging(g, max_degree, False), sums)
    fits = T.StructType(rows.select(*g).schema.fields
                        + [T.StructField("n", T.DoubleType()), T.StructField("m", T.LongType())]
                        + [T.StructField(c, T.DoubleType()) for c in ("xmin", "xmax", "centre", "half")]
                        + [T.StructField("sse", T.ArrayType(T.DoubleType())),
                           T.StructField("coef", T.ArrayType(T.ArrayType(T.DoubleType())))])
    return part.repartition(*g).sortWithinPartitions(*g).mapInArrow(_solving(g, max_degree), fits)


def _rmse_col(d: int) -> Column:
    """RMSE of degree d; NULL when the group has fewer than d+1 distinct x."""
    return F.when(F.col("m") >= d + 1, F.sqrt(F.col("sse")[d - 1] / F.col("n")))


def poly_fit_rmse(df: DataFrame, group_by: list[str], x: str, y: str,
                  max_degree: int = 4, fit: DataFrame | None = None) -> DataFrame:
    """M5: in-sample RMSE of the least-squares polynomial of each degree
    1..max_degree, per group: (group, degree, rmse)."""
    g = list(group_by)
    fit = fit if fit is not None else poly_fit(df, g, x, y, max_degree)
    rows = [F.struct(F.lit(d).alias("degree"), _rmse_col(d).alias("rmse")) for d in range(1, max_degree + 1)]
    out = fit.select(*g, F.explode(F.array(*rows)).alias("r"))
    return out.select(*g, F.col("r.degree").alias("degree"), F.col("r.rmse").alias("rmse"))


def _best_degree_col(max_degree: int) -> Column:
    """Degree with the smallest RMSE; strictly smaller wins, so ties keep the
    lower degree (the reference's ``if rmse < best`` in degree order)."""
    cands = [F.struct(_rmse_col(d).alias("rmse"), F.lit(d).alias("degree")) for d in range(1, max_degree + 1)]
    valid = F.filter(F.array(*cands), lambda c: c["rmse"].isNotNull())
    return F.array_min(valid)


def poly_best_degree(rmse_or_fit: DataFrame, group_by: list[str], max_degree: int = 4) -> DataFrame:
    """M5: the best degree per group, from :func:`poly_fit` rows or from the
    long (group, degree, rmse) rows of :func:`poly_fit_rmse`."""
    g = list(group_by)
    if "sse" in rmse_or_fit.columns:
        b = rmse_or_fit.select(*g, _best_degree_col(max_degree).alias("b")).filter(F.col("b").isNotNull())
        return b.select(*g, F.col("b.degree").alias("best_degree"), F.col("b.rmse").alias("rmse"))
    valid = rmse_or_fit.filter(F.col("rmse").isNotNull())
    best = valid.groupBy(*g).agg(F.min(F.struct("rmse", "degree")).alias("b"))
    return best.select(*g, F.col("b.degree").alias("best_degree"), F.col("b.rmse").alias("rmse"))


def fit_curve_grid(df: DataFrame, group_by: list[str], x: str, y: str,
                   points: int = 1000, max_degree: int = 4,
                   fit: DataFrame | None = None) -> DataFrame:
    """M6: the best-degree fit evaluated on ``points`` evenly spaced x from
    the group's min x to max x. Rows: (group, i, x, y)."""
    g = list(group_by)
    fit = fit if fit is not None else poly_fit(df, g, x, y, max_degree)
    # groups without an identified degree (fewer than 2 distinct x) get no curve
    c = fit.withColumn("best_degree", _best_degree_col(max_degree)["degree"]) \
        .filter(F.col("best_degree").isNotNull())
    step = (F.col("xmax") - F.col("xmin")) / F.lit(points - 1)
    grid = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    xg = F.col("xmin") + F.col("i").cast("double") * step
    grid = grid.withColumn("gx", F.when(F.col("i") == points - 1, F.col("xmax")).otherwise(xg))
    t = (F.col("gx") - F.col("centre")) / F.col("half")
    yv = F.aggregate(F.reverse(F.col("coef")[F.col("best_degree") - 1]), F.lit(0.0), lambda acc, c: acc * t + c)
    return grid.select(*g, F.col("i").alias("i"), F.col("gx").alias("x"), yv.alias("y"))


# ------------------------------------------------------------- M7 pairs

def share_vs_feature(df: DataFrame, ids: list[str], share_col: str, features: list[str],
                     min_share: float | None = None) -> DataFrame:
    """M7: long (ids, share, feature, value) pairs, zero/NULL values dropped,
    optionally only rows whose share exceeds ``min_share``."""
    base = df if min_share is None else df.filter(F.col(share_col) > min_share)
    long_df = unpivot(base.select(*ids, F.col(share_col).cast("double").alias(share_col), *features),
                      [*ids, share_col], features)
    return long_df.filter(F.col("value").isNotNull() & (F.col("value") != 0))
