"""Distributed row numbering: global or per-group ranks without one-task windows.

A ``row_number()`` over a window with no (or a hot) partition key moves every
row of the group into a single task. Here the data is range-partitioned on the
sort key instead (a hot group is split over many partitions), each partition
is sorted locally, and a row's index is

    rows of its group in earlier partitions + its position in this partition
    - the position of its group's first row in this partition.

Only the per-(group, partition) count table (its size is bounded by
groups x partitions, not by rows) goes through a window; it is joined back to
the rows on (group, partition).

Range bounds come from a sample, so two range exchanges of the same rows cut
them differently. The partitioned rows are therefore written once to scratch,
with their partition and place, and both the counts and the rows are read from
there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.functions._util import as_col
from parcelscope.session import materialise

# monotonically_increasing_id() = (partition id << 33) + position in partition.
_POS_MASK = (1 << 33) - 1


def indexed_sort(df: DataFrame, order_by: list, group_by: list[str] | None = None,
                 index_col: str = "row_idx", num_partitions: int | None = None,
                 size_col: str | None = None) -> DataFrame:
    """Attach a 0-based ``index_col`` in ``order_by`` order, restarting per group.

    ``order_by`` items may be names or sort Columns (``F.desc("x")``). Ties get
    distinct, arbitrary indices: a hash of the whole row is the last sort
    key, so a value repeated in many (different) rows is still spread over
    several range partitions, and a retried task sees the same keys.
    ``size_col`` also attaches the size of each row's group (from the same
    count table, no extra pass).
    """
    group_by = list(group_by or [])
    orders = [as_col(c) for c in order_by]
    df = df.withColumn("_tb", F.xxhash64(*[F.col(c) for c in df.columns]))
    keys = [F.col(g) for g in group_by] + orders + [F.col("_tb")]
    parted = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    s = materialise(parted.sortWithinPartitions(*keys)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))),
                    "indexed-sort")
    counts = s.groupBy(*group_by, "_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = (Window.partitionBy(*group_by) if group_by else Window.partitionBy()).orderBy("_pid")
    counts = counts.withColumn(
        "_before",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    extra = []
    if size_col:
        whole = Window.partitionBy(*group_by) if group_by else Window.partitionBy()
        counts = counts.withColumn(size_col, F.sum("_n").over(whole))
        extra = [size_col]
    out = _join_null_safe(s, counts.select(*group_by, "_pid", "_first", "_before", *extra),
                          [*group_by, "_pid"])
    out = out.withColumn(index_col, (F.col("_before") + F.col("_pos") - F.col("_first")).cast("long"))
    return out.drop("_pid", "_pos", "_first", "_before", "_tb")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on ``keys`` where NULL matches NULL (a NULL group is a
    group, as in SQL GROUP BY); the right side's key columns are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, value_col: str, qs: list[float],
                    group_by: list[str] | None = None,
                    names: list[str] | None = None, moments: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy / pandas / DuckDB
    ``quantile_cont`` semantics) per group, NULL values ignored.

    With ``moments`` also count, mean, sample std, min and max, from the same
    written values: the input is read once for all of them.

    No group is ever held in one task, and no hot value either:

    1. values are counted per (group, value): a partial aggregate, so a value
       held by a third of all rows becomes one weighted row;
    2. the distinct values are range-partitioned on (group, value) (unique
       keys, so partitions stay balanced and deterministic) and each gets the
       number of rows before it: a running sum inside its range partition
       plus the rows of its group in earlier partitions (a small
       per-(group, partition) table made from the same written rows);
    3. value v covers ranks [before, before + count); only the values holding
       the (at most 2 x len(qs)) bracketing ranks are kept and combined by a
       grouped aggregate.
    """
    names = names or [f"q{int(round(q * 100))}" for q in qs]
    ungrouped = not group_by
    if ungrouped:
        # one group for the whole table: a constant key keeps every step a
        # plain keyed aggregate / equi-join
        df = df.withColumn("_g", F.lit(0))
        group_by = ["_g"]
    g = list(group_by)
    vals = df.select(*g, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    dv = vals.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    keys = [F.col(c) for c in g] + [F.col("_v")]
    parted = (dv.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id()))
    # rows of the same group before each value inside its range partition: a
    # running sum over the already sorted partition (no re-shuffle)
    schema = T.StructType(parted.schema.fields + [T.StructField("_local", T.LongType(), False)])
    s = materialise(parted.mapInPandas(_running_before(g), schema), "quantiles")
    part = s.groupBy(*g, "_pid").agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_v")).alias("_sum"))
    earlier = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = (part.withColumn("_pbefore", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
            .withColumn("_size", F.sum("_n").over(Window.partitionBy(*g)))
            .withColumn("_mean", F.sum("_sum").over(Window.partitionBy(*g)) / F.col("_size")))
    ranked = _join_null_safe(s, part.select(*g, "_pid", "_pbefore", "_size", "_mean"), [*g, "_pid"])
    ranked = ranked.withColumn("_lo_r", F.col("_pbefore") + F.col("_local")) \
        .withColumn("_hi_r", F.col("_lo_r") + F.col("_c") - 1)

    def holds(r):
        return (F.col("_lo_r") <= r) & (r <= F.col("_hi_r"))

    aggs = []
    wanted = F.lit(False)
    for q, name in zip(qs, names):
        h = F.lit(float(q)) * (F.col("_size") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        wanted = wanted | holds(lo) | holds(hi)
        v_lo = F.max(F.when(holds(lo), F.col("_v")))
        v_hi = F.max(F.when(holds(hi), F.col("_v")))
        frac = F.max(h - lo)
        aggs.append((v_lo + frac * (v_hi - v_lo)).alias(name))
    if moments:
        off = F.col("_v") - F.col("_mean")
        # a group of one value has no sample std
        std = F.when(F.max("_size") > 1, F.sqrt(F.sum(F.col("_c") * off * off) / (F.max("_size") - 1)))
        aggs = [F.max("_size").cast("long").alias("count"), F.max("_mean").alias("mean"), std.alias("std"),
                F.min("_v").alias("min"), F.max("_v").alias("max"), *aggs]
    else:
        ranked = ranked.filter(wanted)
    out = ranked.groupBy(*g).agg(*aggs)
    return out.drop("_g") if ungrouped else out


_NULL = "\x00<null>"


def _running_before(group_cols: list[str]):
    """Per partition (rows sorted by group, then value): for each row, the
    ``_c`` total of the earlier rows of its group in this partition. Runs on
    Arrow batches; the running totals carry over from batch to batch."""
    def run(batches):
        import pandas as pd
        carry: dict = {}
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(_local=pdf["_c"].astype("int64"))
                continue
            # NULL group keys form a group of their own (one sentinel for None/NaN)
            cols = [pdf[c].astype(object).where(pdf[c].notna(), _NULL) for c in group_cols]
            key = cols[0] if len(cols) == 1 else pd.Series(list(zip(*cols)), index=pdf.index)
            excl = pdf["_c"].groupby(key, sort=False).cumsum() - pdf["_c"]
            offset = key.map(lambda k: carry.get(k, 0))
            pdf = pdf.assign(_local=(excl + offset).astype("int64"))
            for k, tot in pdf["_c"].groupby(key, sort=False).sum().items():
                carry[k] = carry.get(k, 0) + int(tot)
            yield pdf
    return run
