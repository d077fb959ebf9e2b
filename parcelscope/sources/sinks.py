"""Sinks (K1-K5): results leave Spark only as files written by the executors.

Nothing is gathered on the driver. ``single_file`` (K2) is for results whose
size is bounded by their keys (reports, per-county tables), never for rows
that grow with the input.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.operators.aggregates import with_total_row


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """K1: write, failing if the target exists (the reference's behaviour)."""
    df.write.mode(mode).parquet(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """K1: one string column as text lines."""
    df.write.mode(mode).text(path)
    return path


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists",
                      header: bool = True) -> str:
    """K2: one output file (``coalesce(1)``) for a small, key-bounded result."""
    w = df.coalesce(1).write.mode(mode)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)
    return path


def write_csv_header(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """K4: CSV with a header line (and no index column)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def count_report(counts: DataFrame, label_col: str, count_col: str, title: str,
                 with_total: bool = True) -> DataFrame:
    """K3: the report rows: title, ``label: n`` lines, ``Total: n``.

    Returned as (line_no, line) so the order is explicit; write it with
    :func:`write_report`. Rerunning with ``mode='append'`` appends again, as
    the reference does; the default overwrites.
    """
    rows = with_total_row(counts, label_col, count_col) if with_total else counts
    body = rows.select(
        F.when(F.col(label_col) == "Total", F.lit(2)).otherwise(F.lit(1)).alias("_part"),
        F.col(label_col).alias("_label"),
        F.concat(F.col(label_col), F.lit(": "), F.col(count_col).cast("string")).alias("line"))
    head = counts.sparkSession.createDataFrame([(0, "", title)], "_part int, _label string, line string")
    return head.unionByName(body)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3: one text file, title first, labels sorted, total last."""
    (report.orderBy("_part", "_label").select("line").coalesce(1)
     .write.mode(mode).text(path))
    return path


def persist(df: DataFrame) -> DataFrame:
    """K5: keep a reused intermediate (memory, spilling to disk)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def reused(df: DataFrame):
    """K5 with an end: ``df`` is kept for the actions within, and released after them,
    also when one fails."""
    kept = persist(df)
    try:
        yield kept
    finally:
        kept.unpersist()
