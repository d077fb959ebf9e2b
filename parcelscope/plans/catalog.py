"""Every operator of SURVEY section 2 as a query over the driver's tables.

Each entry takes (spark, sf_dir) and returns a DataFrame; its DuckDB twin is
in :mod:`parcelscope.plans.oracles` under the same name. Computed doubles are
rounded to 8 significant digits on both sides (with the same arithmetic), and
money sums and averages are computed from exact integer cents, so results
compare by value.

Queries that exercise a source or a sink write their input to a fresh
directory under the shared checkpoint directory and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope import functions as fn
from parcelscope.operators import aggregates as agg
from parcelscope.operators import cluster, joins, reshape, stats
from parcelscope.operators import filters as flt
from parcelscope.operators.ordering import exact_quantiles
from parcelscope.plans import features as feat
from parcelscope.plans import analysis, place_run, standin_files
from parcelscope.plans import standin_data as sd
from parcelscope.session import scratch_path
from parcelscope.sources import catalog, files, results, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(f):
        QUERIES[name] = f
        return f
    return deco


# Computed doubles are compared at this many significant digits: far above
# the last-bit differences of two engines summing in different orders.
SIG_DIGITS = 8


def sig_round(c, s: int = SIG_DIGITS):
    """Round to ``s`` significant digits with exact powers of ten (the same
    arithmetic as the SQL side, so both engines land on the same double)."""
    k = (F.lit(s - 1) - F.floor(F.log10(F.abs(c)))).cast("int")
    ten = F.lit(10.0)
    up = F.round(c * F.pow(ten, k)) / F.pow(ten, k)
    down = F.round(c / F.pow(ten, -k)) * F.pow(ten, -k)
    # |x| < 1e-9 (float noise around an exact zero, and -0.0) becomes 0.0
    return (F.when(c.isNull() | F.isnan(c), c).when(F.abs(c) < 1e-9, F.lit(0.0))
            .when(k >= 0, up).otherwise(down))


def rounded(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Round every double column: to ``digits`` decimals when given (money,
    fixed grids), else to SIG_DIGITS significant digits."""
    def r(c):
        return F.round(c, digits) if digits is not None else sig_round(c)
    cols = [r(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def write_ordered_lines(df: DataFrame, order_col: str, value_col: str, path: str) -> str:
    """Write one text line per row, ordered by ``order_col`` across part files
    (range partitioning keeps the global order in part-file order)."""
    (df.repartitionByRange(order_col).sortWithinPartitions(order_col)
     .select(value_col).write.mode("errorifexists").text(path))
    return path


T_ = sd.table


def cents_avg(col: str):
    """Average of a money column rounded half-up to whole cents, computed from
    exact integer cents (independent of the floating-point summation order)."""
    cents = F.sum(F.round(F.col(col) * 100).cast("long"))
    n = F.count(F.lit(1))
    return F.floor((cents * 2 + n) / (n * 2)) / F.lit(100.0)

# ----------------------------------------------------------------- sources


@query("src_text_lines")
def src_text_lines(spark, d):
    o = T_(spark, d, "orders", "o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "orders-lines")
    o.select(F.concat_ws("|", "o_orderkey", "o_orderstatus").alias("value")).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.select(fn.split_pick("value", 0, "|").cast("long").alias("o_orderkey"),
                        fn.split_pick("value", 1, "|").alias("o_orderstatus"))


@query("src_csv_multiline")
def src_csv_multiline(spark, d):
    c = T_(spark, d, "conversations", "conv_id", "turn", "role", "text")
    path = scratch_path(spark, "conversations-csv")
    (c.write.option("quote", '"').option("escape", '"').option("header", False)
     .option("lineSep", "\n").csv(path))
    back = files.read_csv_records(spark, path, 4)
    return back.select(F.col("_c0").cast("long").alias("conv_id"), F.col("_c1").cast("long").alias("turn"),
                       F.col("_c2").alias("role"), F.md5("_c3").alias("text_md5"))


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query("drop_header_row")
def drop_header_row(spark, d):
    p = T_(spark, d, "part", *PART_COLS)
    header = spark.createDataFrame([tuple(PART_COLS)], PART_COLS)
    body = p.select(*[F.col(c).cast("string") for c in PART_COLS])
    # header first, the same header line again after the last body row
    rows = (header.withColumn("_k", F.lit(-1).cast("long"))
            .unionByName(body.withColumn("_k", F.col("p_partkey").cast("long")))
            .unionByName(header.withColumn("_k", F.lit(1 << 62).cast("long"))))
    path = scratch_path(spark, "part-csv")
    rows.repartitionByRange("_k").sortWithinPartitions("_k").drop("_k").write.csv(path)
    back = files.drop_header_row(files.read_csv_multiline(spark, path, 5))
    return back.select(F.col("_c0").cast("long").alias("p_partkey"), F.col("_c1").alias("p_name"),
                       F.col("_c2").alias("p_brand"), F.col("_c3").alias("p_type"),
                       F.col("_c4").cast("int").alias("p_size"))


@query("skip_first_rows")
def skip_first_rows(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    head = spark.createDataFrame([(-3, "title line"), (-2, "column names"), (-1, "column codes")],
                                 "k long, value string")
    body = c.select(F.col("c_custkey").alias("k"),
                    F.concat_ws("|", "c_custkey", "c_name", "c_nationkey").alias("value"))
    path = write_ordered_lines(head.unionByName(body), "k", "value", scratch_path(spark, "customer-lines"))
    back = files.skip_first_rows(files.read_lines(spark, path), 3, per_file=False)
    return back.select(fn.split_pick("value", 0, "|").cast("long").alias("c_custkey"),
                       fn.split_pick("value", 1, "|").alias("c_name"),
                       fn.split_pick("value", 2, "|").cast("int").alias("c_nationkey"))


@query("row_range_slice")
def row_range_slice(spark, d):
    o = T_(spark, d, "orders", "o_orderkey", "o_orderstatus")
    body = o.select(F.col("o_orderkey").alias("k"),
                    F.concat_ws("|", "o_orderkey", "o_orderstatus").alias("value"))
    path = write_ordered_lines(body, "k", "value", scratch_path(spark, "orders-ordered"))
    sl = files.row_range_slice(files.read_lines(spark, path), 4, 46, index_col="row_idx")
    return sl.select("row_idx", fn.split_pick("value", 0, "|").cast("long").alias("o_orderkey"),
                     fn.split_pick("value", 1, "|").alias("o_orderstatus"))


# Fixed value: the stand-in catalog (dataset -> key column).
CATALOG = [("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"),
           ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
           ("lineitem", "l_orderkey"), ("events", "user_id")]


@query("dataset_catalog")
def dataset_catalog(spark, d):
    entries = [(name, f"{d.rstrip('/')}/{name}.parquet", key) for name, key in CATALOG]
    return catalog.profile(spark, entries)


# The seven hand-typed places of the reference's analysis
# (place, state, all residential parcels), keyed here to a nation.
PLACES = [(0, "denver", "colorado", 211215), (1, "jefferson", "colorado", 133042),
          (2, "weld", "colorado", 117564), (3, "dallas", "texas", 633113),
          (4, "detroit", "michigan", 227204), (5, "houston", "texas", 1208766),
          (6, "placer", "california", 138991)]


@query("inline_table")
def inline_table(spark, d):
    lit = results.inline_table(spark, PLACES, "nationkey int, place string, state string, all_residential long")
    per = agg.count_per_key(T_(spark, d, "customer", "c_nationkey"), "c_nationkey", "n_customers")
    return (lit.join(per, lit.nationkey == per.c_nationkey, "left")
            .select("place", "state", "all_residential",
                    F.coalesce("n_customers", F.lit(0)).cast("long").alias("n_customers")))


def _orders_per_nation(spark, d):
    n = T_(spark, d, "nation", "n_name", "n_nationkey")
    per = sd.order_counts(spark, d, "o_orderstatus")
    j = per.join(n, per.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(F.sum("n").alias("total"),
                                   F.sum(F.when(F.col("o_orderstatus") == "O", F.col("n")).otherwise(0)).alias("open"))


@query("parse_result_lines")
def parse_result_lines(spark, d):
    per = _orders_per_nation(spark, d)
    line = F.concat(F.lit("("), F.col("n_name"), F.lit(","),
                    F.lit('total:"'), F.col("total").cast("string"), F.lit('"'),
                    F.lit('open:"'), F.col("open").cast("string"), F.lit('")'))
    path = scratch_path(spark, "result-lines")
    per.select(line.alias("value")).write.text(path)
    back = results.parse_result_lines(spark, path, ["total", "open"])
    return back.select(F.col("key").alias("n_name"), F.col("total").cast("long").alias("total"),
                       F.col("open").cast("long").alias("open"))


@query("record_block_pivot")
def record_block_pivot(spark, d):
    n = T_(spark, d, "nation", "n_nationkey", "n_name")
    c = T_(spark, d, "customer", "c_nationkey", "c_acctbal")
    per = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), fn.money_sum("c_acctbal").alias("s"),
                                       F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    j = n.join(per, n.n_nationkey == per.c_nationkey, "left")
    fields = ["n_name", "n_customers", "sum_acctbal", "min_acctbal", "max_acctbal"]
    vals = [F.col("n_name"), F.col("n").cast("string"), F.col("s").cast("string"),
            F.col("lo").cast("string"), F.col("hi").cast("string")]
    lines = j.select(F.explode(F.array(*[
        F.struct((F.col("n_nationkey").cast("long") * 5 + i).alias("k"), F.coalesce(v, F.lit("")).alias("value"))
        for i, v in enumerate(vals)])).alias("l")).select("l.*")
    path = write_ordered_lines(lines, "k", "value", scratch_path(spark, "nation-blocks"))
    piv = results.record_block_pivot(files.read_lines(spark, path), 5, fields)
    return piv.select("record", "n_name",
                      F.nullif("n_customers", F.lit("")).cast("long").alias("n_customers"),
                      *[F.nullif(f, F.lit("")).cast("double").alias(f) for f in fields[2:]])


# ------------------------------------------------------------------- sinks

CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("sink_round_trip")
def sink_round_trip(spark, d):
    c = T_(spark, d, "customer", *CUST_COLS)
    path = sinks.write_parquet(c, scratch_path(spark, "customer-parquet"))
    return spark.read.parquet(path)


@query("sink_single_file")
def sink_single_file(spark, d):
    c = T_(spark, d, "customer", "c_nationkey", "c_acctbal")
    per = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"),
                                       fn.money_sum("c_acctbal").alias("total_acctbal"))
    path = sinks.write_single_file(per, scratch_path(spark, "nation-summary"), "csv")
    schema = "c_nationkey int, n long, total_acctbal double"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("sink_csv_header")
def sink_csv_header(spark, d):
    c = T_(spark, d, "customer", *CUST_COLS)
    path = sinks.write_csv_header(c, scratch_path(spark, "customer-csv"))
    return spark.read.schema(c.schema).option("header", True).csv(path)


@query("count_report_with_total")
def count_report_with_total(spark, d):
    # K3 end to end: write the report file (title, `label: n` lines, `Total: n`),
    # read it back, drop the title line by position and parse the lines
    counts = agg.count_by_value(T_(spark, d, "part", "p_type"), "p_type", "n")
    report = sinks.count_report(counts, "p_type", "n", "Count of all part types")
    path = sinks.write_report(report, scratch_path(spark, "type-report"))
    lines = files.skip_first_rows(files.read_lines(spark, path), 1)
    label = F.regexp_extract("value", r"^(.*): (\d+)$", 1)
    n = F.regexp_extract("value", r"^(.*): (\d+)$", 2).cast("long")
    return lines.select(label.alias("p_type"), n.alias("n"))


# -------------------------------------------------------------- projections


def _part_line():
    return F.concat_ws(",", *[F.col(c).cast("string") for c in PART_COLS])


@query("split_pick")
def split_pick(spark, d):
    p = T_(spark, d, "part", *PART_COLS).select(_part_line().alias("line"))
    return p.select(fn.split_pick("line", 0).cast("long").alias("p_partkey"),
                    fn.split_pick("line", 1).alias("p_name"),
                    fn.split_pick("line", 4).cast("int").alias("p_size"))


def _quoted_customer_line():
    return F.concat(F.lit('"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('",'),
                    F.col("c_acctbal").cast("string"), F.lit(","), F.col("c_custkey").cast("string"), F.lit(",,"))


@query("split_quoted")
def split_quoted(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    lines = c.select(_quoted_customer_line().alias("line"))
    arr = fn.split_quoted("line")
    trimmed = fn.split_quoted("line", keep_trailing_empty=False)
    return lines.select(F.get(arr, 2).cast("long").alias("c_custkey"),
                        fn.strip_quotes(F.get(arr, 0)).alias("name_seg"),
                        F.get(arr, 1).cast("double").alias("c_acctbal"),
                        F.nullif(F.get(arr, 4), F.lit("")).alias("last_field"),
                        F.size(arr).cast("long").alias("n_fields"),
                        F.size(trimmed).cast("long").alias("n_fields_trimmed"))


@query("pick_by_position")
def pick_by_position(spark, d):
    c = T_(spark, d, "customer", *CUST_COLS)
    line = F.concat_ws(",", *[F.col(x).cast("string") for x in CUST_COLS])
    rec = c.select(fn.csv_fields(line, 5).alias("r"))
    # column spec: position -> (name, type)
    spec = {0: ("c_custkey", "long"), 3: ("c_acctbal", "double")}
    return rec.select(*[F.col("r")[f"_c{k}"].cast(t).alias(nm) for k, (nm, t) in spec.items()])


@query("null_label")
def null_label(spark, d):
    p = T_(spark, d, "part", "p_brand", "p_size")
    lab = p.select(fn.null_label(F.when(F.col("p_size") >= 10, F.col("p_brand"))).alias("label"))
    return agg.count_by_value(lab, "label")


@query("lower_label")
def lower_label(spark, d):
    c = T_(spark, d, "customer", "c_mktsegment")
    return agg.count_by_value(c.select(fn.lower_label("c_mktsegment").alias("segment")), "segment")


@query("tag_source")
def tag_source(spark, d):
    s = T_(spark, d, "supplier", "s_suppkey", "s_acctbal").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"))
    c = T_(spark, d, "customer", "c_custkey", "c_acctbal").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"))
    return reshape.union_sources([reshape.tag(s, "source", "supplier"), reshape.tag(c, "source", "customer")])


@query("clean_key")
def clean_key(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_nationkey")
    n = T_(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = T_(spark, d, "region", "r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    raw = F.concat(F.lit('"'), F.substring("r_name", 1, 2), F.col("n_name"), F.lit(' County"'))
    state, county = fn.clean_key(raw)
    return j.select("c_custkey", state.alias("state"), county.alias("county"))


@query("strip_quotes")
def strip_quotes(spark, d):
    o = T_(spark, d, "orders", "o_orderkey", "o_orderstatus")
    q = o.select("o_orderkey", F.concat(F.lit('"'), "o_orderstatus", F.lit('"')).alias("t"))
    return q.select("o_orderkey", fn.strip_quotes("t").alias("o_orderstatus"))


@query("parse_int")
def parse_int(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_size")
    t = F.when(F.col("p_size") % 7 == 0, F.lit("N")).otherwise(
        F.concat(F.lit('"'), F.col("p_size").cast("string"), F.lit('"')))
    return p.select("p_partkey", fn.parse_int(t).alias("p_size"))


@query("parse_double")
def parse_double(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_acctbal")
    t = F.when(F.col("c_acctbal") < 0, F.lit("N")).otherwise(
        F.concat(F.lit('"'), F.col("c_acctbal").cast("string"), F.lit('"')))
    return c.select("c_custkey", fn.parse_double(t).alias("c_acctbal"))


@query("occupancy_share")
def occupancy_share(spark, d):
    o = sd.order_geo_counts(spark, d, "o_orderstatus")
    full = F.col("o_orderstatus") == "F"
    a = o.groupBy("county").agg(F.sum("n").alias("total"), F.sum(F.when(full, F.col("n")).otherwise(0)).alias("occupied"),
                                F.sum(F.when(~full, F.col("n")).otherwise(0)).alias("vacant"))
    return rounded(a.select("county", "total", fn.ratio("occupied", "total").alias("occupied_share"),
                            fn.ratio("vacant", "total").alias("vacant_share")))


@query("estimate_margin")
def estimate_margin(spark, d):
    c = sd.customer_geo(spark, d, "c_acctbal")
    # the estimate is rounded half-up to whole cents from exact integer cents,
    # so it does not depend on the floating-point order of the sum
    a = c.groupBy("county").agg(cents_avg("c_acctbal").alias("estimate"),
                                F.round(F.stddev_samp("c_acctbal"), 2).alias("margin"))
    text = fn.estimate_margin_text(F.format_string("%.2f", "estimate"), F.format_string("%.2f", "margin"))
    return a.select("county", "estimate", "margin", text.alias("text"))


EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]


def _user_modes(spark, d):
    e = T_(spark, d, "events", "user_id", "event_type")
    return e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("event_type") == t).alias(t) for t in EVENT_TYPES])


@query("commute_modes")
def commute_modes(spark, d):
    return _user_modes(spark, d)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query("race_shares")
def race_shares(spark, d):
    c = sd.customer_geo(spark, d, "c_mktsegment")
    a = c.groupBy("county").agg(*[
        (F.lit(100.0) * F.count_if(F.col("c_mktsegment") == s) / F.count(F.lit(1))).alias(f"{s.lower()}_pct")
        for s in SEGMENTS])
    return rounded(a)


@query("single_measure")
def single_measure(spark, d):
    c = T_(spark, d, "customer", "c_nationkey", "c_acctbal")
    return rounded(exact_quantiles(c, "c_acctbal", [0.5], ["c_nationkey"], names=["median_acctbal"]))


@query("quality_array")
def quality_array(spark, d):
    c = T_(spark, d, "customer", "c_nationkey", "c_acctbal")
    a = c.groupBy("c_nationkey").agg(F.array(
        F.count(F.lit(1)).cast("double"), fn.money_avg("c_acctbal"), F.min("c_acctbal"),
        F.max("c_acctbal"), fn.money_sum("c_acctbal")).alias("q"))
    names = ["n_customers", "avg_acctbal", "min_acctbal", "max_acctbal", "sum_acctbal"]
    return rounded(a.select("c_nationkey", *[fn.pick("q", i).alias(nm) for i, nm in enumerate(names)]))


@query("strip_suffix")
def strip_suffix(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_nationkey")
    n = T_(spark, d, "nation", "n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select("c_custkey", fn.strip_suffix(F.concat("n_name", F.lit(" County"))).alias("county"))


@query("sentinel_zero")
def sentinel_zero(spark, d):
    c = T_(spark, d, "customer", "c_mktsegment", "c_acctbal")
    t = F.when(F.col("c_acctbal") < 0, F.lit("N")).otherwise(F.col("c_acctbal").cast("string"))
    v = c.select("c_mktsegment", fn.sentinel_zero(t).alias("v"))
    return rounded(v.groupBy("c_mktsegment").agg(F.sum("v").alias("total_acctbal")))


@query("share_with_guard")
def share_with_guard(spark, d):
    m = _user_modes(spark, d)
    total = F.when(F.col("user_id") % 10 == 0, F.lit(None)).otherwise(F.col("total"))
    return rounded(m.select("user_id", fn.share_with_guard("click", total).alias("click_share")))


@query("mode_share")
def mode_share(spark, d):
    m = _user_modes(spark, d)
    shares = fn.mode_shares("total", {t: t for t in ["click", "view", "purchase", "error"]})
    return rounded(m.select("user_id", *[c.alias(f"{k}_share") for k, c in shares.items()]))


@query("percent_text")
def percent_text(spark, d):
    li = T_(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount")
    t = F.format_string("%.2f%%", F.col("l_discount") * 100)
    return rounded(li.select("l_orderkey", "l_linenumber", fn.percent_text(t).alias("l_discount")))


@query("currency_text")
def currency_text(spark, d):
    o = T_(spark, d, "orders", "o_orderkey", "o_totalprice")
    t = F.concat(F.lit('"$'), F.format_number("o_totalprice", 2), F.lit('"'))
    return rounded(o.select("o_orderkey", fn.currency_text(t).alias("o_totalprice")), 2)


@query("ratio_text")
def ratio_text(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_size")
    t = F.concat(F.col("p_size").cast("string"), F.lit("/1000"))
    return rounded(p.select("p_partkey", fn.ratio_text(t).alias("rate")))


@query("first_match_in_array")
def first_match_in_array(spark, d):
    p = T_(spark, d, "part", "p_brand", "p_type")
    nested = agg.nest_histogram(agg.histogram_per_key(p, "p_brand", "p_type"), "p_brand", "p_type")
    m = fn.first_match("histogram", "AR")
    return nested.select("p_brand", m["label"].alias("first_type"), fn.first_match_count("histogram", "AR").alias("n"))


@query("housing_mix")
def housing_mix(spark, d):
    return rounded(feat.residential_mix(spark, d))


# ------------------------------------------------------------------ filters

@query("keyword_any_filter")
def keyword_any_filter(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_name")
    return p.filter(flt.keyword_any("p_name", sd.RESIDENTIAL_WORDS))


@query("prefix_filter")
def prefix_filter(spark, d):
    o = T_(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return o.filter(flt.prefix("o_orderpriority", "5"))


@query("prefix_any_filter")
def prefix_any_filter(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_brand")
    return p.filter(flt.prefix_any("p_brand", ["Brand#1", "Brand#2"]))


KEY_SET = ["NATION_1", "NATION_3", "NATION_7"]


@query("key_in_set")
def key_in_set(spark, d):
    c = T_(spark, d, "customer", "c_custkey", "c_nationkey")
    n = T_(spark, d, "nation", "n_nationkey", "n_name").filter(flt.key_in_set("n_name", KEY_SET))
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


SHARE_CUT = 0.125


@query("numeric_threshold")
def numeric_threshold(spark, d):
    return rounded(feat.residential_mix(spark, d).filter(flt.threshold("percent_residential", ">", SHARE_CUT)))


@query("nonzero_mask")
def nonzero_mask(spark, d):
    long_df = reshape.unpivot(_user_modes(spark, d), ["user_id"], EVENT_TYPES, "event_type", "cnt")
    nz = long_df.filter(flt.nonzero("cnt"))
    return rounded(nz.groupBy("event_type").agg(F.avg("cnt").alias("mean_nonzero"),
                                                F.count(F.lit(1)).alias("n_nonzero")))


# -------------------------------------------------------------------- joins

def _band(balance: str):
    """Thousands of an amount, rounded down."""
    return F.floor(F.col(balance) / 1000.0).cast("long").alias("band")


@query("left_join_default")
def left_join_default(spark, d):
    """Customers with the mean balance of the suppliers of their nation and thousand."""
    c = T_(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal").select("c_custkey", "c_nationkey", _band("c_acctbal"))
    s = T_(spark, d, "supplier", "s_nationkey", "s_acctbal")
    health = s.groupBy(F.col("s_nationkey").alias("c_nationkey"), _band("s_acctbal")).agg(F.avg("s_acctbal").alias("health"))
    return rounded(joins.left_join_default(c, health, ["c_nationkey", "band"], {"health": 0.0}))


def _two_state_keys(df, nation_col):
    """(state, county) where the county name collides across regions."""
    return df.select("*", F.concat(F.lit("c"), (F.col(nation_col) % 5).cast("string")).alias("county"))


@query("lookup_update")
def lookup_update(spark, d):
    """Customers per county and thousand of balance; where the county has orders of
    that many thousands, the last one's price instead."""
    c = T_(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    n = T_(spark, d, "nation", "n_nationkey", "n_regionkey")
    keys = _two_state_keys(n, "n_nationkey").withColumnRenamed("n_regionkey", "state")
    # customers are counted, and updates cut to each customer's, then each nation's last, before the joins
    per = c.groupBy("c_nationkey", _band("c_acctbal")).agg(F.count(F.lit(1)).alias("n"))
    base = (per.join(keys, per.c_nationkey == keys.n_nationkey).groupBy("state", "county", "band")
            .agg(F.sum("n").cast("double").alias("value")))
    o = T_(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    last = F.max(F.struct("o_orderkey", "o_totalprice")).alias("u")
    of_customer = o.groupBy("o_custkey", _band("o_totalprice")).agg(last)
    of_nation = (of_customer.join(c.select("c_custkey", "c_nationkey"), of_customer.o_custkey == c.c_custkey)
                 .groupBy("c_nationkey", "band").agg(F.max("u").alias("u")))
    upd = of_nation.join(keys, of_nation.c_nationkey == keys.n_nationkey).select(
        "state", "county", "band", F.col("u.o_orderkey").alias("o_orderkey"), F.col("u.o_totalprice").alias("value"))
    return rounded(joins.lookup_update(base, upd, ["state", "county", "band"], ["value"], order_col="o_orderkey"))


@query("feature_table")
def feature_table(spark, d):
    return rounded(feat.county_features(spark, d))


# ------------------------------------------------------------- aggregations

@query("count_by_value")
def count_by_value(spark, d):
    return agg.count_by_value(sd.parcel_counts(spark, d), "label", "n", weight="n")


@query("count_per_key")
def count_per_key(spark, d):
    per = agg.count_per_key(T_(spark, d, "lineitem", "l_suppkey"), "l_suppkey")
    s = T_(spark, d, "supplier", "s_suppkey", "s_nationkey")
    g = sd.geo(spark, d)
    of_nation = per.join(s, per.l_suppkey == s.s_suppkey).groupBy("s_nationkey").agg(F.sum("n").alias("n"))
    return agg.count_per_key(of_nation.join(g, of_nation.s_nationkey == g.n_nationkey), "county", weight="n")


@query("histogram_per_key")
def histogram_per_key(spark, d):
    return sd.parcel_counts(spark, d).select("county", "label", "n")


@query("group_values")
def group_values(spark, d):
    p = T_(spark, d, "part", "p_type", "p_brand")
    g = agg.group_values(p, "p_type", "p_brand", "brands")
    return g.select("p_type", F.array_join("brands", ",").alias("brands"))


TYPE_PREFIXES = ["PRO", "SMA"]


def _brand_type_hist(spark, d):
    p = T_(spark, d, "part", "p_brand", "p_type")
    return agg.histogram_per_key(p, "p_brand", "p_type")


@query("histogram_filtered")
def histogram_filtered(spark, d):
    h = _brand_type_hist(spark, d)
    return agg.histogram_filtered(h, h, "p_brand", flt.prefix_any("p_type", TYPE_PREFIXES))


@query("histogram_total")
def histogram_total(spark, d):
    h = _brand_type_hist(spark, d)
    kept = agg.histogram_filtered(h, h, "p_brand", flt.prefix_any("p_type", TYPE_PREFIXES))
    return agg.histogram_total(kept, "p_brand")


@query("distinct_values")
def distinct_values(spark, d):
    return agg.distinct_values(T_(spark, d, "part", "p_type"), "p_type")


def _feature_long(spark, d):
    return reshape.unpivot(feat.county_features(spark, d), feat.KEY, feat.FEATURES)


@query("describe_nonzero")
def describe_nonzero(spark, d):
    return rounded(agg.describe_nonzero(_feature_long(spark, d)))


# ---------------------------------------------------------- reshape / sort

@query("explode_filtered")
def explode_filtered(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_name")
    lab = p.select("p_brand", F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("label"))
    # one row per value already: the elements are kept by a filter, nothing is nested first
    return lab.filter(F.col("label").contains(sd.SINGLE_WORD) & F.col("p_brand").isNotNull()).distinct()


@query("union_sources")
def union_sources(spark, d):
    p = T_(spark, d, "part", "p_partkey", "p_type", "p_name", "p_size")
    lab = F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("label")
    size = F.col("p_size")
    slices = [("small", size <= 10), ("medium", (size > 10) & (size <= 30)), ("large", size.isNull() | (size > 30))]
    frames = [reshape.tag(p.filter(keep).select("p_partkey", lab), "source", nm) for nm, keep in slices]
    return reshape.union_sources(frames)


@query("zip_columns")
def zip_columns(spark, d):
    p = T_(spark, d, "part", "p_type", "p_brand")
    nested = agg.nest_histogram(agg.histogram_per_key(p, "p_type", "p_brand"), "p_type", "p_brand")
    parallel = nested.select("p_type", F.col("histogram.label").alias("brands"), F.col("histogram.n").alias("counts"))
    return reshape.zip_columns(parallel, ["p_type"], ["brands", "counts"], ["p_brand", "n"]) \
        .select("p_type", F.col("pos").cast("long").alias("pos"), "p_brand", "n")


@query("unpivot_features")
def unpivot_features(spark, d):
    return rounded(_feature_long(spark, d))


@query("sort_by_key")
def sort_by_key(spark, d):
    c = count_by_value(spark, d)
    return reshape.sort_by_key(c, ["label"], "rank")


@query("top_k_single")
def top_k_single(spark, d):
    return rounded(reshape.top_k(feat.residential_mix(spark, d), "percent_residential", 5, ["state", "county"]))


@query("top_k_multi")
def top_k_multi(spark, d):
    return rounded(reshape.top_k(feat.residential_mix(spark, d), "percent_multi", 5, ["state", "county"]))


def _quality_measures(spark, d):
    """Five per-county 'qualities' (E7's stand-in) as numbers."""
    c = sd.customer_geo(spark, d, "c_acctbal", "c_mktsegment")
    return c.groupBy("state", "county").agg(
        F.count(F.lit(1)).alias("n_customers"),
        cents_avg("c_acctbal").alias("avg_acctbal"),
        F.round(F.min("c_acctbal"), 2).alias("min_acctbal"),
        F.round(F.max("c_acctbal"), 2).alias("max_acctbal"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("n_building"))


@query("render_record")
def render_record(spark, d):
    q = _quality_measures(spark, d)
    pairs = [("customers", F.col("n_customers").cast("string")),
             ("avgBalance", F.format_string("%.2f", "avg_acctbal")),
             ("minBalance", F.format_string("%.2f", "min_acctbal")),
             ("maxBalance", F.format_string("%.2f", "max_acctbal")),
             ("building", F.col("n_building").cast("string"))]
    return q.select("county", reshape.render_record(F.col("county"), pairs).alias("record"))


# ---------------------------------------------------------------- analytics

@query("zscore")
def zscore(spark, d):
    f = sd.customer_features(spark, d)
    return rounded(stats.zscore(f, sd.CUSTOMER_FEATURES, keep=["c_custkey"]))


@query("kmeans_elbow")
def kmeans_elbow(spark, d):
    f = sd.customer_features(spark, d)
    return cluster.kmeans_elbow(spark, f, sd.CUSTOMER_FEATURES)


@query("kmeans_assign")
def kmeans_assign(spark, d):
    f = sd.customer_features(spark, d)
    return cluster.kmeans_assign(f, ["c_custkey"], sd.CUSTOMER_FEATURES, k=6)


@query("kmeans_sse_k1")
def kmeans_sse_k1(spark, d):
    f = sd.customer_features(spark, d)
    z = stats.zscore(f, sd.CUSTOMER_FEATURES, keep=[])
    return cluster.sse_of_mean(z, sd.CUSTOMER_FEATURES).select(F.round("sse", 2).alias("sse"))


@query("kmeans_one_step")
def kmeans_one_step(spark, d):
    f = sd.customer_features(spark, d)
    z = stats.zscore(f, sd.CUSTOMER_FEATURES, keep=["c_custkey"])
    # six fixed starting centres: the six smallest customer keys (k x d values)
    rows = z.orderBy("c_custkey").limit(6).collect()
    centres = [[r[c] for c in sd.CUSTOMER_FEATURES] for r in rows]
    return rounded(cluster.lloyd_step(z, sd.CUSTOMER_FEATURES, centres).drop("sse"))


@query("kmeans_fixed_sse")
def kmeans_fixed_sse(spark, d):
    """SSE per cluster of a batch of fixed models (k = 2, 4, 6) in one pass."""
    f = sd.customer_features(spark, d)
    z = stats.zscore(f, sd.CUSTOMER_FEATURES, keep=["c_custkey"])
    rows = z.orderBy("c_custkey").limit(6).collect()
    centres = [[r[c] for c in sd.CUSTOMER_FEATURES] for r in rows]
    totals = cluster.totals(z, sd.CUSTOMER_FEATURES, [centres[:k] for k in (2, 4, 6)])
    return rounded(totals.select((2 * F.col("model") + 2).alias("k"), "cluster", "n", "sse"))


FIT_X, FIT_Y, FIT_G = "l_quantity", "l_extendedprice", ["l_returnflag"]


def _fit_input(spark, d):
    return T_(spark, d, "lineitem", "l_returnflag", FIT_X, FIT_Y)


@query("linear_fit")
def linear_fit(spark, d):
    return rounded(stats.linear_fit(_fit_input(spark, d), FIT_G, FIT_X, FIT_Y))


@query("poly_fit_rmse")
def poly_fit_rmse(spark, d):
    return rounded(stats.poly_fit_rmse(_fit_input(spark, d), FIT_G, FIT_X, FIT_Y))


@query("poly_best_degree")
def poly_best_degree(spark, d):
    fit = stats.poly_fit(_fit_input(spark, d), FIT_G, FIT_X, FIT_Y)
    return rounded(stats.poly_best_degree(fit, FIT_G))


@query("fit_curve_grid")
def fit_curve_grid(spark, d):
    return rounded(stats.fit_curve_grid(_fit_input(spark, d), FIT_G, FIT_X, FIT_Y))


@query("share_vs_feature")
def share_vs_feature(spark, d):
    ft = feat.county_features(spark, d)
    others = [f for f in feat.FEATURES if f not in ("percent_residential",)]
    return rounded(stats.share_vs_feature(ft, feat.KEY, "percent_residential", others, min_share=SHARE_CUT))


# ------------------------------------- the analysis as one run, from fixed centres

def _analysis(spark, d):
    """E9 on the county features; its clusters start and stay at the first three counties."""
    ft = feat.county_features(spark, d)
    t = ft.filter(flt.threshold("all_residential", ">", 1))
    rows = stats.zscore(t, feat.FEATURES, keep=feat.KEY).orderBy(*feat.KEY).limit(3).collect()
    centres = [[r[f] for f in feat.FEATURES] for r in rows]
    return analysis.analyze(spark, ft, feat.KEY, feat.FEATURES, min_share=SHARE_CUT, ks=(), centres=centres)


@query("analysis_summary")
def analysis_summary(spark, d):
    return rounded(_analysis(spark, d)["summary"])


@query("analysis_top")
def analysis_top(spark, d):
    res = _analysis(spark, d)
    cols = [*feat.KEY, "percent_residential", "percent_multi"]
    return rounded(reshape.union_sources([reshape.tag(res[f"top_{x}"].select(*cols), "ranking", x) for x in ("single", "multi")]))


@query("analysis_pairs")
def analysis_pairs(spark, d):
    """M7 with the cluster of each county."""
    return rounded(_analysis(spark, d)["pairs"])


@query("analysis_linear")
def analysis_linear(spark, d):
    return rounded(_analysis(spark, d)["linear"])


# ------------------------------------------------------ end-to-end programs

@query("residential_profile")
def residential_profile(spark, d):
    # parcels pre-aggregated per (source, label); the keyword filter runs on
    # `part` before its join, and the per-source totals come from the
    # histogram itself (no second pass over lineitem)
    counts = sd.parcel_counts(spark, d, sd.RESIDENTIAL_WORDS, by=["l_returnflag"])
    hist = counts.groupBy("l_returnflag", "label").agg(F.sum("n").cast("long").alias("n"))
    totals = agg.histogram_total(hist, "l_returnflag", out_col="key_total")
    totals = totals.withColumnRenamed("l_returnflag", "_flag")
    return (hist.join(totals, hist.l_returnflag.eqNullSafe(totals["_flag"])).drop("_flag")
            .withColumnRenamed("l_returnflag", "source"))


# Stand-in land-use codes. Codes starting with one of these
# count as residential, and these longer prefixes are the kept ones.
RES_CODE_PREFIX = ["1", "2", "3"]
KEPT_CODE_PREFIX = ["1-U", "2-H"]


@query("residential_by_code")
def residential_by_code(spark, d):
    o = sd.order_geo_counts(spark, d, "o_orderpriority", flt.prefix_any("o_orderpriority", RES_CODE_PREFIX))
    hist = o.groupBy("county", "o_orderpriority").agg(F.sum("n").cast("long").alias("n"))
    kept = hist.filter(flt.prefix_any("o_orderpriority", KEPT_CODE_PREFIX))
    tot = agg.histogram_total(kept, "county", out_col="kept_total")
    return hist.join(tot, "county", "left").select(
        "county", F.col("o_orderpriority").alias("code"), "n",
        F.coalesce("kept_total", F.lit(0)).cast("long").alias("kept_total"))


@query("city_label_counts")
def city_label_counts(spark, d):
    li = T_(spark, d, "lineitem", "l_partkey")
    lab = sd.part_labels(spark, d)
    # pre-aggregate lineitems per part before attaching the label
    per_part = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    labelled = per_part.join(lab, per_part.l_partkey == lab.p_partkey).groupBy("label") \
        .agg(F.sum("n").cast("long").alias("n"))
    all_rep = agg.with_total_row(labelled, "label").withColumn("report", F.lit("all"))
    kept = labelled.filter(flt.keyword_any("label", sd.RESIDENTIAL_WORDS))
    kept_rep = agg.with_total_row(kept, "label").withColumn("report", F.lit("residential"))
    return all_rep.unionByName(kept_rep)


@query("quality_of_life")
def quality_of_life(spark, d):
    q = _quality_measures(spark, d)
    s = T_(spark, d, "supplier", "s_nationkey", "s_acctbal")
    g = sd.geo(spark, d)
    health = s.join(g, s.s_nationkey == g.n_nationkey).groupBy("state", "county") \
        .agg(F.avg("s_acctbal").alias("mental_health"))
    return rounded(joins.left_join_default(q, health, ["state", "county"], {"mental_health": 0.0}))


# ------------------------- the programs themselves, on files made from the tables

@query("place_label_report")
def place_label_report(spark, d):
    """E1-E3 by place_run: label counts with their total, all and residential."""
    prof = place_run.zoning_profile(spark, standin_files.write_place(spark, d), standin_files.PLACE)
    return reshape.union_sources([reshape.tag(prof["all_labels"], "report", "all"),
                                  reshape.tag(prof["residential_labels"], "report", "residential")])


@query("place_county_labels")
def place_county_labels(spark, d):
    """E1, E2 by place_run: residential label counts per county."""
    root = standin_files.write_place(spark, d)
    return place_run.zoning_profile(spark, root, standin_files.PLACE)["histogram"]


@query("place_measures")
def place_measures(spark, d):
    """E4, E5, E7 by place_run: six commute modes, poverty with margins, five qualities and health."""
    root = standin_files.write_place(spark, d)
    parts = place_run.census_measures(spark, root, standin_files.PLACE)
    modes, poverty, quality = parts[1], parts[2], parts[4]
    return rounded(modes.join(poverty, place_run.KEY).join(quality, place_run.KEY))


@query("place_features")
def place_features(spark, d):
    """E1-E8, J3 by place_run: the feature table of a place."""
    return rounded(place_run.place_features(spark, standin_files.write_place(spark, d), standin_files.PLACE))
