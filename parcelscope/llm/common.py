"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder, reread it.

    A written table outlives lost executors, and later stages read it as often
    as they like without running what made it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any frame; other columns, clashing names included, are
    left out, and a null text counts as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows, chosen by a hash of ``key`` (all rows, if fewer)."""
    n = df.count()
    if n <= most:
        return df
    share = int(most / n * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < share)


def per_text(fn: Callable[[list, list[str]], dict[str, list]], schema: pa.Schema,
             chars: int = 4_000_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: ``fn(ids, texts)`` over runs of rows with about
    ``chars`` characters, so a worker's memory doesn't depend on the batch size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            at = 0
            while at < len(ids):
                got: list[str] = []
                size = 0
                while at + len(got) < len(ids) and (not got or size < chars):
                    got.append(texts[at + len(got)].as_py())
                    size += len(got[-1])
                out = fn(ids[at:at + len(got)], got)
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                at += len(got)
    return run


def any_true(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


# ---------------------------------------------------------------- a filter of ids ahead of a join

#: Bits of the filter, and the parts it is put together in: 2 MB whatever the data.
FILTER_BITS, FILTER_PARTS = 1 << 24, 64


def _places(ids: pa.Array) -> np.ndarray:
    """Two places of each id in the filter."""
    x = ids.fill_null(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.stack([(x >> np.uint64(39)) % np.uint64(FILTER_BITS), (x >> np.uint64(7)) % np.uint64(FILTER_BITS)]).astype(np.int64)


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        bits[_places(batch.column(0))] = True
    parts = np.packbits(bits).reshape(FILTER_PARTS, -1)
    used = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())],
                                     names=["part", "bits"])


def _joined_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(b, np.uint8)
            total[k] = total[k] | x if k in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["part", "bits"])


def _probable(docs: DataFrame, ids: DataFrame, key: str) -> Callable[[bool], DataFrame]:
    """A function that gives the rows of ``docs`` whose ids are, or are not,
    probably in ``ids``: told by a Bloom filter of fixed size, which goes to the
    scan. One that is full, for very many ids, takes all rows for probable."""
    ddl = "part int, bits binary"
    rows = ids.select(key).mapInArrow(_set_bits, ddl).repartition("part").mapInArrow(_joined_bits, ddl).collect()
    whole = np.zeros((FILTER_PARTS, FILTER_BITS // FILTER_PARTS // 8), np.uint8)
    for r in rows:
        whole[r.part] = np.frombuffer(r.bits, np.uint8)
    packed = whole.ravel()

    at_id = docs.columns.index(key)

    def rows_that(are: bool) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = _places(batch.column(at_id))
                hit = (packed[at >> 3] >> (7 - (at & 7)) & 1).all(axis=0)
                yield batch.filter(pa.array(hit == are))
        return docs.mapInArrow(keep, docs.schema)
    return rows_that


def with_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in ``ids``. The join is exact; only rows
    that probably match are shuffled to it."""
    return _probable(docs, ids, key)(True).join(ids.select(key), key, "left_semi").select(docs.columns)


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` isn't in ``ids``, null ids included; rows
    that surely aren't never reach the join."""
    rows_that = _probable(docs, ids, key)
    return rows_that(False).union(
        rows_that(True).join(ids.select(key), key, "left_anti").select(docs.columns))
