"""A dataset catalog (name -> path, key column) driving one loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.operators.reshape import union_sources


def load(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one catalogued dataset by format."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "text":
        return spark.read.text(path)
    raise ValueError(f"unknown format {fmt!r}")


def profile(spark: SparkSession, entries: list[tuple[str, str, str]], fmt: str = "parquet") -> DataFrame:
    """One row per dataset: (dataset, n_rows, n_keys) for (name, path, key)
    entries. Each dataset is read with only its key column; the per-dataset
    aggregates are unioned into one plan (one job)."""
    frames = []
    for name, path, key in entries:
        t = load(spark, path, fmt).select(key)
        frames.append(t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))
                      .select(F.lit(name).alias("dataset"), "n_rows", "n_keys"))
    return union_sources(frames)
