"""Reshape, set and sort operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.functions._util import as_col
from parcelscope.operators.ordering import indexed_sort


def explode_filtered(df: DataFrame, array_col: str, predicate, out_col: str = "value") -> DataFrame:
    """Keep the elements of an array that pass ``predicate`` (a function
    Column -> Column), one row per kept element.

    When the data is not nested yet, a plain ``filter`` on the rows is the
    same thing and should be used instead (no grouping needed at all).
    """
    kept = F.filter(F.col(array_col), predicate)
    return df.select(*[c for c in df.columns if c != array_col], F.explode(kept).alias(out_col))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant key column."""
    return df.withColumn(name, F.lit(value))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """R2: union all by column name (a narrow step, no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def zip_columns(df: DataFrame, keys: list[str], arrays: list[str], names: list[str] | None = None) -> DataFrame:
    """Transpose parallel arrays into rows (one row per position)."""
    names = names or arrays
    z = F.arrays_zip(*[F.col(a).alias(n) for a, n in zip(arrays, names)])
    out = df.select(*keys, F.posexplode(z).alias("pos", "_z"))
    return out.select(*keys, "pos", *[F.col("_z")[n].alias(n) for n in names])


def unpivot(df: DataFrame, ids: list[str], values: list[str], feature_col: str = "feature",
            value_col: str = "value", cast: str | None = "double") -> DataFrame:
    """Wide -> long ``(ids..., feature, value)``."""
    cols = [F.col(v).cast(cast).alias(v) if cast else F.col(v) for v in values]
    wide = df.select(*ids, *cols)
    return wide.unpivot(ids, values, feature_col, value_col)


def sort_by_key(df: DataFrame, keys: list, rank_col: str = "rank") -> DataFrame:
    """Order by key; the position is materialised as ``rank_col`` (1-based)
    by distributed range-partitioned numbering, so it survives any later
    shuffle or file split; sort on it where rows are shown or written in order."""
    out = indexed_sort(df, keys, index_col=rank_col)
    return out.withColumn(rank_col, F.col(rank_col) + 1)


def top_k(df: DataFrame, by: str, k: int, tie_break: list[str], descending: bool = True) -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``by``, ties broken
    by ``tie_break``. Planned as TakeOrderedAndProject: each task keeps k rows.
    """
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in tie_break]).limit(k)


def render_record(key: Column, pairs: list[tuple[str, Column]], indent: str = "\t") -> Column:
    """A multi-line record: the key, then one ``name:value`` line per pair."""
    lines = [key.cast("string")]
    for name, c in pairs:
        lines.append(F.concat(F.lit(f"{indent}{name}:"), F.coalesce(c.cast("string"), F.lit("null"))))
    return F.concat_ws("\n", *lines)
