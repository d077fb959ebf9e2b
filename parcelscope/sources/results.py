"""Reading saved result lines back into columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.functions._util import as_col
from parcelscope.sources.files import with_row_index


def inline_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A literal table (hand-typed values) as a DataFrame."""
    return spark.createDataFrame(rows, schema)


# Fixed value: the shape of a saved pair line, ``(key,value)``.
PAIR_LINE = r"^\((.*?),(.*)\)$"


def parse_pair_line(col) -> tuple:
    """Split ``(key,value)`` into (key, value) text columns.

    The key ends at the first comma, as the saved tuples are written; the
    value keeps everything up to the closing parenthesis.
    """
    c = as_col(col)
    return (F.regexp_extract(c, PAIR_LINE, 1), F.regexp_extract(c, PAIR_LINE, 2))


def labelled_value(col, label: str, next_labels: list[str] | None = None):
    """The text after ``label:`` up to the next known label (or the end)
    in a value like ``total:"12"open:"3"``; surrounding quotes removed."""
    c = as_col(col)
    stop = "|".join(_esc(n) + ":" for n in (next_labels or []))
    tail = f"(?=(?:{stop}))" if stop else "$"
    pat = _esc(label) + r":(.*?)" + tail
    return F.translate(F.regexp_extract(c, pat, 1), '"', "")


def parse_result_lines(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """Read ``(key,label1:v1label2:v2...)`` lines into (key, label1, ...)."""
    lines = spark.read.text(path)
    key, value = parse_pair_line("value")
    cols = [labelled_value(value, lab, labels[i + 1:]).alias(lab) for i, lab in enumerate(labels)]
    return lines.select(F.translate(key, '"', "").alias("key"), *cols)


def record_block_pivot(scan: DataFrame, block: int, fields: list[str],
                       index_col: str = "row_idx", value_col: str = "value") -> DataFrame:
    """Every ``block`` consecutive lines form one record; line ``i`` of a
    block is field ``fields[i]``. Returns one row per record with the
    record number and one text column per field.

    Uses the distributed row index, then a keyed aggregate on the record
    number (``max(when(field == i))``), which is a pivot with fixed columns.
    """
    idx = scan if index_col in scan.columns else with_row_index(scan, index_col)
    t = idx.select((F.col(index_col) / block).cast("long").alias("record"),
                   (F.col(index_col) % block).cast("int").alias("_f"),
                   F.col(value_col))
    aggs = [F.max(F.when(F.col("_f") == i, F.col(value_col))).alias(name) for i, name in enumerate(fields)]
    return t.groupBy("record").agg(*aggs)


def _esc(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)
