"""Sources and sinks (S1-S9, K1-K5) on invented files."""

import os

import pytest
from pyspark.sql import functions as F

from parcelscope.sources import files, results, sinks
from parcelscope.operators.aggregates import count_by_value


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_row_index_is_global_over_many_splits(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "big", "part-00000.txt")
    write(p, "".join(f"line {i:05d}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        scan = files.read_lines(spark, os.path.dirname(p))
        assert scan.rdd.getNumPartitions() > 5
        rows = files.with_row_index(scan).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3000
    assert all(r.value == f"line {r.row_idx:05d}" for r in rows)


def test_row_index_per_file_and_across_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "multi")
    write(os.path.join(d, "a.txt"), "h1\nh2\nh3\na1\na2\n")
    write(os.path.join(d, "b.txt"), "h1\nh2\nh3\nb1\n")
    kept = sorted(r.value for r in files.skip_first_rows(files.read_lines(spark, d), 3, per_file=True).collect())
    assert kept == ["a1", "a2", "b1"]
    glob = {r.value: r.row_idx for r in files.with_row_index(files.read_lines(spark, d)).collect()
            if r.value in ("a1", "b1")}
    assert glob == {"a1": 3, "b1": 8}


def test_skip_exactly_n_rows_leaves_nothing(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "only_header")
    write(os.path.join(d, "x.txt"), "t\nn\nc\n")
    assert files.skip_first_rows(files.read_lines(spark, d), 3).count() == 0


def test_row_range_slice(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "slice")
    write(os.path.join(d, "x.txt"), "".join(f"{i}\n" for i in range(50)))
    got = [int(r.value) for r in files.row_range_slice(files.read_lines(spark, d), 8, 46).collect()]
    assert sorted(got) == list(range(8, 46))
    one = files.row_range_slice(files.read_lines(spark, d), 7).collect()
    assert [r.value for r in one] == ["7"]


def test_multiline_csv_and_header_drop(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "csv")
    body = ('id,name,zone\n'
            '1,"Main St, North",single family\n'
            '2,"two\nline",\n'
            'id,name,zone\n'
            '3,plain,warehouse\n')
    write(os.path.join(d, "p.csv"), body)
    df = files.read_csv_multiline(spark, d, 3)
    out = files.drop_header_row(df)
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [("1", "Main St, North", "single family"), ("2", "two\nline", None),
                    ("3", "plain", "warehouse")]


def test_parse_result_lines_and_blocks(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "res")
    write(os.path.join(d, "part-00000"), '(adams,total:"12"open:"3")\n(van wert,total:"7"open:"0")\n')
    got = sorted(tuple(r) for r in results.parse_result_lines(spark, d, ["total", "open"]).collect())
    assert got == [("adams", "12", "3"), ("van wert", "7", "0")]
    b = os.path.join(tmpdir_path, "blocks")
    write(os.path.join(b, "part-00000"), "(adams,\n\tcrime:42/1000\n\tjobs:3%\n(brown,\n\tcrime:1/1000\n\tjobs:4%\n")
    piv = results.record_block_pivot(files.read_lines(spark, b), 3, ["key", "crime", "jobs"]).orderBy("record")
    assert [(r.record, r.key, r.crime) for r in piv.collect()] == [
        (0, "(adams,", "\tcrime:42/1000"), (1, "(brown,", "\tcrime:1/1000")]


def test_sinks_round_trip_and_report(spark, tmpdir_path):
    df = spark.createDataFrame([("house", 1), ("house", 2), ("apt", 3)], "label string, id int")
    p = sinks.write_parquet(df, os.path.join(tmpdir_path, "pq"))
    assert spark.read.parquet(p).count() == 3
    c = sinks.write_single_file(count_by_value(df, "label"), os.path.join(tmpdir_path, "one"), "csv")
    assert len([f for f in os.listdir(c) if f.endswith(".csv")]) == 1
    rep = sinks.count_report(count_by_value(df, "label"), "label", "n", "Count of all residential")
    out = sinks.write_report(rep, os.path.join(tmpdir_path, "report"))
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == ["Count of all residential", "apt: 1", "house: 2", "Total: 3"]


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    from parcelscope.session import ensure_checkpoint_dir, scratch_path
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_report_append_and_text_sink(spark, tmpdir_path):
    df = spark.createDataFrame([("house",), ("apt",), ("house",)], "label string")
    rep = sinks.count_report(count_by_value(df, "label"), "label", "n", "Count")
    out = os.path.join(tmpdir_path, "rep")
    sinks.write_report(rep, out)                 # default overwrite
    sinks.write_report(rep, out, mode="append")  # a rerun appends, as the reference's writer did
    lines = [r.value for r in spark.read.text(out).collect()]
    assert sorted(lines) == sorted(["Count", "apt: 1", "house: 2", "Total: 3"] * 2)
    t = sinks.write_text(df, os.path.join(tmpdir_path, "txt"))
    assert sorted(r.value for r in spark.read.text(t).collect()) == ["apt", "house", "house"]
    try:
        sinks.write_text(df, t)  # errorifexists by default
        raise AssertionError("expected the second write to fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_first_row_matches_the_whole_path(spark, tmpdir_path):
    # a second file whose path ends with the first file's path must not be taken
    a = os.path.join(tmpdir_path, "data", "p.csv")
    b = os.path.join(tmpdir_path, "z", tmpdir_path.lstrip("/"), "data", "p.csv")
    write(a, "h1,h2\n1,2\n")
    write(b, "zz,zz\n3,4\n")
    df = files.read_csv_multiline(spark, [a, b], 2)
    assert tuple(files.first_row(df)) == ("h1", "h2")
    assert sorted(tuple(r) for r in files.drop_header_row(df).collect()) == [("1", "2"), ("3", "4"), ("zz", "zz")]


def test_catalog_profile_text_and_unknown_format(spark, tmpdir_path):
    import pytest
    from parcelscope.sources import catalog
    d = os.path.join(tmpdir_path, "cat")
    write(os.path.join(d, "a.txt"), "x\ny\nx\n")
    prof = catalog.profile(spark, [("lines", d, "value")], fmt="text").collect()
    assert [(r.dataset, r.n_rows, r.n_keys) for r in prof] == [("lines", 3, 2)]
    with pytest.raises(ValueError):
        catalog.load(spark, d, "xml")


def test_header_with_an_empty_first_file(spark, tmp_path):
    d = tmp_path / "parts"
    d.mkdir()
    for name, text in (("part-0.csv", ""), ("part-1.csv", "a,b\n1,2\n"), ("part-2.csv", "a,b\n3,4\n")):
        (d / name).write_text(text)
    df = files.read_csv_multiline(spark, str(d), 2)
    assert tuple(files.first_row(df)) == ("a", "b")
    assert sorted(tuple(r) for r in files.drop_header_row(df).collect()) == [("1", "2"), ("3", "4")]


def test_skip_per_file_is_one_pass_without_join(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    for i in range(40):
        (d / f"part-{i:02d}.txt").write_text("".join(f"h{j}\n" for j in range(3)) + "".join(f"{i}-{j}\n" for j in range(i)))
    out = files.skip_first_rows(files.read_lines(spark, str(d)), 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted(r.value for r in out.collect()) == sorted(f"{i}-{j}" for i in range(40) for j in range(i))
    one = files.row_range_slice(files.read_lines(spark, str(d)), 3, 4, per_file=True)
    assert sorted(r.value for r in one.collect()) == sorted(f"{i}-0" for i in range(1, 40))


def test_skip_over_later_blocks(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i:05d}\n" for i in range(5000)))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        scan = files.read_lines(spark, str(path))
        assert scan.rdd.getNumPartitions() > 3
        assert sorted(r.value for r in files.skip_first_rows(scan, 2).collect()) == [f"line {i:05d}" for i in range(2, 5000)]
        with pytest.raises(Exception, match="maxPartitionBytes"):
            files.skip_first_rows(scan, 3000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def quoted_rows(seed, n):
    import random
    r = random.Random(seed)
    cell = lambda: r.choice(["plain", "", "two\nlines", "a,b", 'say "hi"', "x\n\n\ny", "é漢\n,", "\n", '"', "end\n" * r.randint(1, 60)])
    return [[str(i), cell(), cell()] for i in range(n)]


def csv_text(rows):
    def field(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n') else v
    return "".join(",".join(map(field, r)) + "\n" for r in rows)


@pytest.mark.parametrize("block", [37, 200, 1 << 20])
def test_quoted_records_across_splits(spark, tmp_path, block):
    """Any split edge, within quoted fields too: the rows of the one-task read."""
    rows = {k: quoted_rows(k, 60) for k in range(3)}
    for k, rs in rows.items():
        (tmp_path / f"p{k}.csv").write_text(csv_text(rs))
    (tmp_path / "p3.csv").write_text("")
    (tmp_path / "p4.csv").write_text('0,"open\nat\nits end",z')  # no last newline
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if block == 200 else "100")
    try:
        key = lambda r: tuple((v is not None, v) for v in r)
        got = sorted((tuple(r) for r in files.read_csv_records(spark, str(tmp_path), 3).collect()), key=key)
        one = sorted((tuple(r) for r in files.read_csv_multiline(spark, str(tmp_path), 3).collect()), key=key)
        assert got == one and len(got) == 181
        assert [r for r in got if r[2] == "z"] == [("0", "open\nat\nits end", "z")]
        if block > 1000:
            left = files.read_csv_records(spark, str(tmp_path), 3, skip=2).collect()
            assert sorted(int(r._c0) for r in left) == sorted([*range(2, 60)] * 3)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)


def test_quoted_records_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    rows = [[str(i), f"line {i}\nof \"{i % 7}\", here", "x" * (i % 50)] for i in range(200_000)]
    path.write_text(csv_text(rows))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = files.read_csv_records(spark, str(path), 3)
        assert df.rdd.getNumPartitions() > 5
        h = [F.count("*"), F.bit_xor(F.xxhash64("_c0", "_c1", "_c2"))]
        assert df.agg(*h).first() == spark.createDataFrame(rows, "_c0 string, _c1 string, _c2 string").withColumn(
            "_c2", F.when(F.col("_c2") != "", F.col("_c2"))).agg(*h).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
