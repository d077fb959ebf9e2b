"""Aggregations (A1-A11, K3's total row).

All counting is a keyed ``groupBy`` with map-side partial aggregation, so a
hot key costs one partial row per input partition, never a whole group in one
task. Nested results (lists, histograms) are only built *after* grouping by
(key, value), so their length is bounded by the number of distinct values per
key, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.functions._util import as_col
from parcelscope.operators.ordering import exact_quantiles


def _rows(weight: str | None):
    """The number of rows, or of the rows that pre-counted ones stand for."""
    return F.sum(weight).cast("long") if weight else F.count(F.lit(1))


def count_by_value(df: DataFrame, col: str, count_col: str = "n", weight: str | None = None) -> DataFrame:
    """A1 (and A11): number of rows per distinct value."""
    return df.groupBy(col).agg(_rows(weight).alias(count_col))


def count_per_key(df: DataFrame, key: str | list[str], count_col: str = "n", weight: str | None = None) -> DataFrame:
    """A4: rows per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(_rows(weight).alias(count_col))


def with_total_row(counts: DataFrame, label_col: str, count_col: str = "n",
                   total_label: str = "Total") -> DataFrame:
    """A2/K3: the label counts plus one ``Total`` row holding their sum.

    Expressed as a ``rollup`` on the label, so Spark computes the labels and
    the grand total in one aggregation.
    """
    out = (counts.rollup(label_col)
           .agg(F.sum(count_col).cast("long").alias(count_col), F.grouping(label_col).alias("_g")))
    return out.select(
        F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(label_col)).alias(label_col),
        F.col(count_col))


def label_report(df: DataFrame, label_col: str, count_col: str = "n",
                 total_label: str = "Total") -> DataFrame:
    """E3's report: count per label and the total, from the labelled rows."""
    return with_total_row(count_by_value(df, label_col, count_col), label_col, count_col, total_label)


def group_values(df: DataFrame, key: str, value: str, out_col: str = "values",
                 sort: bool = True) -> DataFrame:
    """A3: the distinct values of each key as one array (sorted).

    Values are de-duplicated by a (key, value) aggregate first, so the array
    is bounded by the value vocabulary; an undeduplicated list would grow with
    the data and is not offered.
    """
    distinct = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    agg = F.collect_list(value)
    out = distinct.groupBy(key).agg(agg.alias(out_col))
    return out.withColumn(out_col, F.sort_array(out_col)) if sort else out


def histogram_per_key(df: DataFrame, key: str | list[str], label: str,
                      count_col: str = "n") -> DataFrame:
    """A5, long form: rows per (key, label)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias(count_col))


def nest_histogram(hist: DataFrame, key: str | list[str], label: str, count_col: str = "n",
                   out_col: str = "histogram") -> DataFrame:
    """A5, nested form: ``array<struct<label, n>>`` per key, sorted by label.

    Input is the long form, so each array holds one element per distinct label.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = hist.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(label).alias("label"),
                                             F.col(count_col).alias("n")))).alias(out_col))
    return out


def histogram_filtered(hist: DataFrame, keys_df: DataFrame, key: str, predicate,
                       count_col: str = "n") -> DataFrame:
    """Keep histogram rows whose label passes ``predicate``; keys without
    any kept label stay, with NULL label and count 0. ``keys_df`` may be the
    histogram itself: it holds every key, and saves a scan of its input."""
    kept = hist.filter(predicate)
    out = keys_df.select(key).distinct().join(kept, on=key, how="left")
    return out.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0).cast("long")))


def histogram_total(hist: DataFrame, key: str, count_col: str = "n",
                    out_col: str = "total") -> DataFrame:
    """Sum of the histogram per key (long form)."""
    return hist.groupBy(key).agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("long").alias(out_col))


def nested_total(nested_col, count_field: str = "n"):
    """A7 on the nested form: fold the array without exploding it."""
    return F.aggregate(as_col(nested_col), F.lit(0).cast("long"),
                       lambda acc, x: acc + x[count_field].cast("long"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A8."""
    return df.select(col).distinct()


def describe_nonzero(long_df: DataFrame, feature_col: str = "feature",
                     value_col: str = "value") -> DataFrame:
    """A10: per feature, over its non-zero, non-NULL values: count, mean,
    sample std, min, 25/50/75 % (linear interpolation), max.

    ``long_df`` is the (feature, value) long form (R4). Moments and quartiles come
    from one pass of :func:`exact_quantiles`, which counts equal values, ranges
    the different ones over partitions, and never gathers a feature in one task.
    """
    vals = long_df.select(feature_col, F.col(value_col).cast("double").alias(value_col)) \
        .filter(F.col(value_col).isNotNull() & (F.col(value_col) != 0))
    out = exact_quantiles(vals, value_col, [0.25, 0.5, 0.75], [feature_col], names=["p25", "p50", "p75"], moments=True)
    return out.select(feature_col, "count", "mean", "std", "min", "p25", "p50", "p75", "max")
