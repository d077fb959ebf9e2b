"""File sources (S1-S5): text lines, multi-line CSV, header handling, row index.

Row index (S4/S5). Positions in a file are only meaningful straight after the
scan. The index of a line is computed without a global sort and without a
one-task window:

* every scanned row gets ``monotonically_increasing_id()`` (consecutive inside
  a task) and its split's ``(_metadata.file_path, file_block_start)``;
* one aggregate gives, per split, its row count and its first id (one row per
  split: the table is bounded by input size / split size, not by rows);
* a running sum over that small table, in (file, split start) order, gives
  each split's offset; it is joined back on the split.

``per_file=True`` restarts the index in every file; otherwise files are taken
in path order, which is the part-file order Spark writes.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.session import materialise


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, ``value: string``."""
    return spark.read.text(path)


def string_schema(n_cols: int, prefix: str = "_c") -> T.StructType:
    return T.StructType([T.StructField(f"{prefix}{i}", T.StringType(), True) for i in range(n_cols)])


def read_csv_multiline(spark: SparkSession, path: str | list[str], n_cols: int,
                       header: bool = False, sep: str = ",") -> DataFrame:
    """Headerless CSV whose quoted fields may hold commas and newlines.

    All columns are strings named ``_c0 ..``; the schema is given, never
    inferred. A multi-line CSV file cannot be split, so Spark reads one file
    per task: large inputs should arrive as many files.
    """
    return (spark.read.schema(string_schema(n_cols))
            .option("multiLine", True).option("header", header)
            .option("sep", sep).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def _quote_splits(lines: DataFrame) -> DataFrame:
    """Per split of a text scan: whether it begins inside quotes (``_in``), the first and
    last line with an odd number of quotes, and the split that owns its first record.

    A split's quote count comes from one aggregate; whether it begins inside quotes
    is the parity of the counts before it in its file, a running sum over splits.
    """
    per = lines.groupBy("_fp", "_bs").agg(
        F.sum("_odd").alias("_q"), F.min(F.when(F.col("_odd") == 1, F.col("_mid"))).alias("_lo"),
        F.max(F.when(F.col("_odd") == 1, F.col("_mid"))).alias("_hi"), F.max("_mid").alias("_last"))
    before = Window.partitionBy("_fp").orderBy("_bs").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_in", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2 == 1)
    # a record begins in the split unless its first line goes on to its end
    begins = ~F.col("_in") | (F.col("_lo") < F.col("_last"))
    per = (per.withColumn("_own", F.last(F.when(begins, F.col("_bs")), ignorenulls=True).over(before))
           .withColumn("_out", F.col("_in") != (F.col("_q") % 2 == 1)))
    return materialise(per.select(F.col("_fp").alias("_f"), F.col("_bs").alias("_b"), "_in", "_out", "_own", "_lo", "_hi"),
                       "csv-splits")


def _whole_records(batches):
    """mapInArrow body: lines in order, no record crossing a split -> records with
    the split they begin in and their place there."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    schema = pa.schema([("_fp", pa.string()), ("_bs", pa.int64()), ("_at", pa.int64()), ("_rec", pa.string())])
    open_lines: list[str] = []
    split, place = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        value, fp, bs = batch.column("value"), batch.column("_fp"), batch.column("_bs")
        odd = batch.column("_odd").to_numpy()
        inside = (len(open_lines) > 0) ^ ((np.cumsum(odd) - odd) & 1).astype(bool)
        starts = np.flatnonzero(~inside)
        ends_open = bool(inside[-1]) ^ bool(odd[-1])
        first = int(starts[0]) if len(starts) else n
        done, files_, blocks = [], [], []
        if first and open_lines:
            open_lines += value.slice(0, first).to_pylist()
            if len(starts) or not ends_open:
                done.append("\n".join(open_lines))
                files_.append(split[0])
                blocks.append(split[1])
                open_lines = []
        whole = starts[:-1] if ends_open and len(starts) else starts
        stop = int(starts[-1]) if ends_open and len(starts) else n
        if len(whole):
            lists = pa.ListArray.from_arrays(pa.array(np.r_[whole, stop], pa.int32()), value)
            done += pc.binary_join(lists, "\n").to_pylist()
            files_ += fp.take(pa.array(whole)).to_pylist()
            blocks += bs.take(pa.array(whole)).to_pylist()
        at = []
        for key in zip(files_, blocks):
            split, place = (key, 0) if key != split else (split, place + 1)
            at.append(place)
        if ends_open and len(starts):
            open_lines = value.slice(stop).to_pylist()
            key = (fp[stop].as_py(), bs[stop].as_py())
            if key != split:
                split, place = key, -1
        yield pa.RecordBatch.from_arrays([pa.array(files_, pa.string()), pa.array(blocks, pa.int64()), pa.array(at, pa.int64()),
                                          pa.array(done, pa.string())], schema=schema)


def read_csv_records(spark: SparkSession, path: str | list[str], n_cols: int, sep: str = ",", skip: int = 0) -> DataFrame:
    """S2 for files of any size: the rows of :func:`read_csv_multiline`, read by many tasks.

    Files are scanned as lines, which split anywhere. A line begins inside a quoted
    field iff the quotes before it in its file are odd in number, so the records
    follow from each split's quote count and a running sum over splits. Records
    within a split are put together in the task that reads it; the lines of those
    that cross an edge (the head and tail of a split, known from its first and last
    odd line) are grouped by the split that the record begins in. Spark's CSV parser
    then reads whole records. ``skip`` drops the first rows of each file, which must
    lie in its first split.

    Quotes must be used as in RFC 4180 (around whole fields, doubled within); other
    files need the one-task reader. Lines end in ``\\n`` or ``\\r\\n``; empty lines
    between records count as none.
    """
    meta = F.col("_metadata")
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", meta["file_path"].alias("_fp"), meta["file_block_start"].alias("_bs"),
        F.monotonically_increasing_id().alias("_mid"), (quotes % 2).cast("int").alias("_odd"))
    splits = _quote_splits(lines)
    known = lines.join(splits, (F.col("_fp") == F.col("_f")) & (F.col("_bs") == F.col("_b")))
    head = F.col("_in") & (F.col("_lo").isNull() | (F.col("_mid") <= F.col("_lo")))
    tail = F.col("_out") & F.coalesce(F.col("_mid") >= F.col("_hi"), F.lit(True))
    # in order whatever join was picked; a broadcast one leaves nothing to sort
    inner = known.filter(~head & ~tail).sortWithinPartitions("_fp", "_bs", "_mid").select("value", "_fp", "_bs", "_odd")
    whole = inner.mapInArrow(_whole_records, "_fp string, _bs long, _at long, _rec string")
    owner = F.when(head, F.coalesce("_own", F.col("_bs"))).otherwise(F.col("_bs"))
    crossing = (known.filter(head | tail).withColumn("_owner", owner).groupBy("_fp", F.col("_owner").alias("_bs"))
                .agg(F.array_sort(F.collect_list(F.struct(F.col("_bs").alias("b"), F.col("_mid").alias("m"), F.col("value").alias("v")))).alias("_l"))
                .select("_fp", "_bs", F.lit(1 << 40).alias("_at"), F.array_join("_l.v", "\n").alias("_rec")))
    rec = whole.union(crossing).withColumn("_rec", F.regexp_replace("_rec", "\r$", "")).filter(F.col("_rec") != "")
    if skip:
        rec = rec.filter((F.col("_bs") > 0) | (F.col("_at") >= skip))
    row = F.from_csv("_rec", string_schema(n_cols).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                     {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return rec.select(row.alias("_row")).select("_row.*")


def _splits(scan: DataFrame, per_file: bool) -> tuple[DataFrame, DataFrame]:
    """The scan with split and id of each row, and the table of splits: its rows
    (``_n``), first id and the rows before it. The table is written once, so its
    size is known when it is joined, and a small one is broadcast."""
    s = scan.select("*",
                    F.col("_metadata.file_path").alias("_fp"),
                    F.col("_metadata.file_block_start").alias("_bs"),
                    F.monotonically_increasing_id().alias("_mid"))
    splits = s.groupBy("_fp", "_bs").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = (Window.partitionBy("_fp").orderBy("_bs") if per_file
         else Window.partitionBy().orderBy("_fp", "_bs"))
    return s, materialise(splits.withColumn(
        "_before", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "splits")


def with_row_index(scan: DataFrame, index_col: str = "row_idx", per_file: bool = False,
                   keep_file: bool = False) -> DataFrame:
    """S4 helper: a 0-based line/row index on a freshly scanned file source."""
    s, splits = _splits(scan, per_file)
    out = s.join(splits.select("_fp", "_bs", "_first", "_before"), on=["_fp", "_bs"], how="inner")
    out = out.withColumn(index_col, (F.col("_before") + F.col("_mid") - F.col("_first")).cast("long"))
    drop = ["_bs", "_mid", "_first", "_before"] + ([] if keep_file else ["_fp"])
    out = out.drop(*drop)
    return out.withColumnRenamed("_fp", "file_path") if keep_file else out


def _with_block(scan: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return scan.select("*", meta["file_path"].alias("_fp"), meta["file_block_start"].alias("_bs"),
                       (meta["file_size"] - meta["file_block_start"] - meta["file_block_length"]).alias("_rest"))


def _head_slice(n_cols: int, lo: int, hi: int | None, placed: bool = False):
    """Rows [lo, hi) of each file, told from their place in the file's first block
    (added as a column with ``placed``); rows of later blocks count as beyond ``hi``
    and are passed on if it is None."""
    need = lo if hi is None else hi

    def run(batches):
        import numpy as np
        import pyarrow as pa
        file, seen, rest = None, 0, 0

        def check() -> None:
            if file is not None and file[1] == 0 and rest > 0 and seen < need:
                raise ValueError(f"the first block of {file[0]} has {seen} rows, {need} are needed: "
                                 "raise spark.sql.files.maxPartitionBytes")
        for batch in batches:
            fp, bs, left = (batch.column(n_cols + i) for i in range(3))
            key = list(zip(fp.to_pylist(), bs.to_pylist()))
            keep = np.ones(len(key), bool)
            at = np.zeros(len(key), np.int64)
            cuts = [i for i in range(len(key)) if i == 0 or key[i] != key[i - 1]] + [len(key)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if key[i] != file:
                    check()
                    file, seen, rest = key[i], 0, left[i].as_py()
                if file[1] == 0:
                    at[i:j] = place = seen + np.arange(j - i)
                    keep[i:j] = (place >= lo) & (place < hi if hi is not None else True)
                else:
                    keep[i:j] = hi is None
                seen += j - i
            own = batch.select(list(range(n_cols)))
            if placed:
                own = pa.RecordBatch.from_arrays([*own.columns, pa.array(at)], names=[*own.schema.names, "_at"])
            yield own.filter(pa.array(keep))
        check()
    return run


def skip_first_rows(scan: DataFrame, n: int, per_file: bool = True) -> DataFrame:
    """Drop the first ``n`` rows of each file (header blocks).

    Per file this is one pass without a join: only rows of a file's first block
    can be among them. A first block with fewer rows, in a file of several
    blocks, is an error. Over all files (``per_file=False``) see
    :func:`row_range_slice`.
    """
    if not per_file:
        # only splits that begin before row n hold rows to drop: the others' rows join with nothing
        s, splits = _splits(scan, per_file=False)
        head = splits.filter(F.col("_before") < n).select("_fp", "_bs", "_first", "_before")
        out = s.join(head, ["_fp", "_bs"], "left").filter(
            F.col("_before").isNull() | (F.col("_before") + F.col("_mid") - F.col("_first") >= n))
        return out.select(scan.columns)
    cols = len(scan.columns)
    return _with_block(scan).mapInArrow(_head_slice(cols, n, None), scan.schema)


def row_range_slice(scan: DataFrame, lo: int, hi: int | None = None,
                    per_file: bool = False, index_col: str | None = None) -> DataFrame:
    """Rows whose position is in ``[lo, hi)`` (``hi=None``: only ``lo``).

    Per file, one pass as in :func:`skip_first_rows`.
    """
    end = lo + 1 if hi is None else hi
    if per_file:
        schema = T.StructType([*scan.schema.fields, *([T.StructField("_at", T.LongType())] if index_col else [])])
        out = _with_block(scan).mapInArrow(_head_slice(len(scan.columns), lo, end, index_col is not None), schema)
        return out.withColumnRenamed("_at", index_col) if index_col else out
    name = index_col or "_ri"
    # only the splits that hold rows of the slice are joined
    s, splits = _splits(scan, per_file)
    hit = splits.filter((F.col("_before") < end) & (F.col("_before") + F.col("_n") > lo))
    out = (s.join(hit.select("_fp", "_bs", "_first", "_before"), ["_fp", "_bs"])
           .withColumn(name, (F.col("_before") + F.col("_mid") - F.col("_first")).cast("long"))
           .filter((F.col(name) >= lo) & (F.col(name) < end)))
    return out.select(*scan.columns, *([name] if index_col else []))


def first_row(scan: DataFrame):
    """The first row of a freshly scanned file source: the first row of the first
    file, in path order, that has one (None without rows).

    Files are tried in groups of growing size, so a run of empty files costs few
    jobs; each job reads first blocks only and sends one row to the driver.
    """
    paths, at, size = sorted(scan.inputFiles()), 0, 1
    meta = F.col("_metadata")
    while at < len(paths):
        # the path itself must match, whatever scheme or authority is in front of it
        group = [urlparse(p).path for p in paths[at:at + size]]
        path = F.regexp_replace(meta["file_path"], r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        row = (scan.select("*", path.alias("_path"), meta["file_block_start"].alias("_bs"),
                           F.monotonically_increasing_id().alias("_at"))
               .filter(F.col("_path").isin(group) & (F.col("_bs") == 0))
               .orderBy("_path", "_at").limit(1).drop("_path", "_bs", "_at").first())
        if row is not None:
            return row
        at, size = at + size, min(size * 10, 1000)
    return None


def drop_header_row(df: DataFrame, head=None) -> DataFrame:
    """S3: remove every row equal to the first row (the header), or to ``head``.

    The header is fetched with a one-row job (:func:`first_row`); the filter
    then drops *all* rows equal to it, null-safely, matching the reference.
    """
    if head is None:
        head = first_row(df) if df.inputFiles() else None
    if head is None:  # no file has a row
        return df
    same = None
    for c in df.columns:
        eq = F.col(c).eqNullSafe(F.lit(head[c]))
        same = eq if same is None else (same & eq)
    return df.filter(~same)
