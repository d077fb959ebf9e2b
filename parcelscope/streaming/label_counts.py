"""Incremental label reports with Structured Streaming.

The reference reruns its batch programs as new parcel files arrive. The
same E3 report can be kept current by a streaming query over the parcel
directory: each new file is parsed with the same column functions, and the
per-label counts are a streaming aggregate whose state lives in the
checkpoint location (so a restarted driver or a lost executor resumes from
it). Nothing here is a new operator; it is the batch report on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelscope import functions as fn
from parcelscope.operators import filters as flt
from parcelscope.session import scratch_path
from parcelscope.sources.files import string_schema


def parcel_label_stream(spark: SparkSession, directory: str, label_pos: int, n_cols: int | None = None,
                        words=None, max_files_per_trigger: int = 100) -> DataFrame:
    """A streaming DataFrame of lower-cased labels from CSV parcel files
    landing in ``directory`` (optionally only residential ones)."""
    n = n_cols or label_pos + 1
    rows = (spark.readStream.schema(string_schema(n)).option("header", False)
            .option("multiLine", True).option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(directory))
    labels = rows.select(fn.lower_label(fn.null_label(F.col(f"_c{label_pos}"))).alias("label"))
    return labels.filter(flt.keyword_any("label", words)) if words else labels


def start_label_counts(labels: DataFrame, path: str, checkpoint: str | None = None,
                       header_label: str | None = None) -> StreamingQuery:
    """Keep ``label -> n`` current in Parquet files at ``path``: each micro-batch
    replaces them with the whole report, written by the executors. Rows whose
    label equals ``header_label`` (a header line) are not counted."""
    spark = labels.sparkSession
    if header_label is not None:
        labels = labels.filter(F.col("label") != header_label.lower())
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))

    def replace(report: DataFrame, _: int) -> None:
        report.write.mode("overwrite").parquet(path)
    return (counts.writeStream.outputMode("complete").foreachBatch(replace)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-labels"))
            .start())
