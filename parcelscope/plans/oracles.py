"""DuckDB SQL twins of :mod:`parcelscope.plans.catalog` (same names, same
columns). Tables are the driver's views: region nation customer supplier part
orders lineitem events documents embeddings pages benchmark labels
conversations. Doubles are rounded like the Spark side.
"""

from __future__ import annotations

from parcelscope.plans import standin_files
from parcelscope.plans.places import RACE


def money_avg(c: str) -> str:
    """Average of a 2-decimal money column from exact integer cents."""
    return f"(sum(round({c} * 100)::BIGINT)::DOUBLE / count({c})::DOUBLE / 100.0)"


def money_sum(c: str) -> str:
    return f"(sum(round({c} * 100)::BIGINT)::DOUBLE / 100.0)"


GEO = """geo AS (
  SELECT n.n_nationkey, lower(r.r_name) AS state, lower(n.n_name) AS county
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LABELS = """lab AS (
  SELECT p_partkey, lower(concat_ws(' ', p_type, p_name)) AS label FROM part)"""

PARCEL_COUNTS = f"""{GEO}, {LABELS},
pc AS (
  SELECT g.state, g.county, lab.label, cast(count(*) AS BIGINT) AS n
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo g ON s.s_nationkey = g.n_nationkey
  JOIN lab ON l.l_partkey = lab.p_partkey
  GROUP BY ALL)"""

RES = "(contains(label, 'old') OR contains(label, 'ring') OR contains(label, 'gear'))"

MIX = f"""{PARCEL_COUNTS},
mix0 AS (
  SELECT state, county, cast(sum(n) AS BIGINT) AS all_residential,
         cast(sum(CASE WHEN contains(label, 'ring') THEN n ELSE 0 END) AS BIGINT) AS sf_residential
  FROM pc WHERE {RES} GROUP BY ALL),
mix AS (
  SELECT state, county, all_residential, sf_residential,
         all_residential - sf_residential AS multi_residential,
         sf_residential::DOUBLE / all_residential AS percent_residential,
         (all_residential - sf_residential)::DOUBLE / all_residential AS percent_multi
  FROM mix0)"""

FEATURES = [
    "all_residential", "sf_residential", "multi_residential", "percent_residential",
    "percent_multi", "occupied_share", "vacant_share", "avg_order_price", "mean_acctbal",
    "median_acctbal", "automobile_pct", "building_pct", "supplier_health",
]

FEATURE_CTE = f"""{MIX},
og AS (
  SELECT g.state, g.county, o.o_orderstatus, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey),
occ AS (
  SELECT state, county,
         count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE / count(*) AS occupied_share,
         count(*) FILTER (WHERE o_orderstatus = 'O')::DOUBLE / count(*) AS vacant_share,
         sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / count(*)::DOUBLE / 100.0 AS avg_order_price
  FROM og GROUP BY ALL),
cg AS (
  SELECT g.state, g.county, c.c_acctbal, c.c_mktsegment
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey),
cm AS (
  SELECT state, county, {money_avg("c_acctbal")} AS mean_acctbal,
         quantile_cont(c_acctbal, 0.5) AS median_acctbal,
         100.0 * avg(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1.0 ELSE 0.0 END) AS automobile_pct,
         100.0 * avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) AS building_pct
  FROM cg GROUP BY ALL),
sh AS (
  SELECT g.state, g.county, {money_avg("s.s_acctbal")} AS supplier_health
  FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY ALL),
ft AS (
  SELECT g.state, g.county,
    coalesce(mix.all_residential, 0) AS all_residential,
    coalesce(mix.sf_residential, 0) AS sf_residential,
    coalesce(mix.multi_residential, 0) AS multi_residential,
    coalesce(mix.percent_residential, 0) AS percent_residential,
    coalesce(mix.percent_multi, 0) AS percent_multi,
    coalesce(occ.occupied_share, 0) AS occupied_share,
    coalesce(occ.vacant_share, 0) AS vacant_share,
    coalesce(occ.avg_order_price, 0) AS avg_order_price,
    coalesce(cm.mean_acctbal, 0) AS mean_acctbal,
    coalesce(cm.median_acctbal, 0) AS median_acctbal,
    coalesce(cm.automobile_pct, 0) AS automobile_pct,
    coalesce(cm.building_pct, 0) AS building_pct,
    coalesce(sh.supplier_health, 0) AS supplier_health
  FROM geo g
  LEFT JOIN mix USING (state, county) LEFT JOIN occ USING (state, county)
  LEFT JOIN cm USING (state, county) LEFT JOIN sh USING (state, county))"""


SIG_DIGITS = 8


def sig(expr: str, s: int = SIG_DIGITS) -> str:
    """Round to ``s`` significant digits, as the Spark side does."""
    x = f"(({expr})::DOUBLE)"
    k = f"(CAST({s - 1} - floor(log10(abs({x}))) AS INTEGER))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} WHEN abs({x}) < 1e-9 THEN 0.0::DOUBLE "
            f"WHEN {k} >= 0 THEN round({x} * pow(10.0, {k})) / pow(10.0, {k}) "
            f"ELSE round({x} / pow(10.0, -{k})) * pow(10.0, -{k}) END)")


def _r(expr: str, name: str, digits: int | None = None) -> str:
    if digits is not None:
        return f"round(({expr})::DOUBLE, {digits}) AS {name}"
    return f"{sig(expr)} AS {name}"


FEATURE_LONG = f"""{FEATURE_CTE},
fl AS (
  UNPIVOT (SELECT state, county, {", ".join(f"{f}::DOUBLE AS {f}" for f in FEATURES)} FROM ft)
  ON {", ".join(FEATURES)} INTO NAME feature VALUE value)"""

# E9 on the counties of more than one residential parcel; the first three are the centres
ANALYSIS = f"""{FEATURE_CTE},
an AS (SELECT * FROM ft WHERE all_residential > 1),
az AS (SELECT state, county, {", ".join(
    f"(({f}) - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1) AS {f}" for f in FEATURES)} FROM an),
ac AS (SELECT row_number() OVER (ORDER BY state, county) - 1 AS j, * FROM (SELECT * FROM az ORDER BY state, county LIMIT 3)),
ad AS (SELECT az.state, az.county, ac.j, {" + ".join(f"(az.{f} - ac.{f}) * (az.{f} - ac.{f})" for f in FEATURES)} AS d FROM az, ac),
al AS (SELECT state, county, CAST(arg_min(j, (d, j)) AS INTEGER) AS cluster FROM ad GROUP BY state, county),
pl AS (UNPIVOT (SELECT state, county, percent_residential::DOUBLE AS percent_residential,
                {", ".join(f"{f}::DOUBLE AS {f}" for f in FEATURES if f != "percent_residential")} FROM an WHERE percent_residential > 0.125)
       ON {", ".join(f for f in FEATURES if f != "percent_residential")} INTO NAME feature VALUE value),
pairs AS (SELECT pl.*, al.cluster FROM pl JOIN al USING (state, county) WHERE value IS NOT NULL AND value <> 0)"""

USER_MODES = """um AS (
  SELECT user_id, count(*) AS total,
    count(*) FILTER (WHERE event_type = 'click') AS click,
    count(*) FILTER (WHERE event_type = 'view') AS view,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
    count(*) FILTER (WHERE event_type = 'signup') AS signup,
    count(*) FILTER (WHERE event_type = 'error') AS error
  FROM events GROUP BY user_id)"""

CUST_FEATURES = ["c_acctbal", "n_orders", "total_price", "avg_price", "urgent_share"]

CUST_Z = f"""per AS (
  SELECT o_custkey, count(*)::DOUBLE AS n_orders, sum(o_totalprice) AS total_price,
         avg(o_totalprice) AS avg_price,
         avg(CASE WHEN starts_with(o_orderpriority, '1') THEN 1.0 ELSE 0.0 END) AS urgent_share
  FROM orders GROUP BY o_custkey),
cf AS (
  SELECT c.c_custkey, c.c_acctbal, coalesce(per.n_orders, 0.0) AS n_orders,
         coalesce(per.total_price, 0.0) AS total_price, coalesce(per.avg_price, 0.0) AS avg_price,
         coalesce(per.urgent_share, 0.0) AS urgent_share
  FROM customer c LEFT JOIN per ON c.c_custkey = per.o_custkey),
z AS (
  SELECT c_custkey, {", ".join(
      f"(({f}) - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1) AS {f}"
      for f in CUST_FEATURES)}
  FROM cf)"""

# polynomial fits: recurrence on the (group, x)-binned table
POLY = """b AS (
  SELECT l_returnflag AS g, l_quantity::DOUBLE AS x, count(*)::DOUBLE AS w,
         sum(l_extendedprice) AS sy, sum(l_extendedprice * l_extendedprice) AS syy
  FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY ALL),
k0 AS (
  SELECT g, sum(w) AS n, count(*) AS m, min(x) AS xmin, max(x) AS xmax, sum(w) AS S0,
         sum(w * x) / sum(w) AS a0, sum(sy) / sum(w) AS c0 FROM b GROUP BY g),
t1 AS (SELECT b.*, 1.0 AS p0, b.x - k0.a0 AS p1 FROM b JOIN k0 USING (g)),
k1 AS (
  SELECT k0.*, s.S1, s.xs / s.S1 AS a1, s.S1 / k0.S0 AS b1, s.ys / s.S1 AS c1
  FROM k0 JOIN (SELECT g, sum(w * p1 * p1) AS S1, sum(w * x * p1 * p1) AS xs, sum(p1 * sy) AS ys
                FROM t1 GROUP BY g) s USING (g)),
t2 AS (SELECT t1.*, (t1.x - k1.a1) * t1.p1 - k1.b1 * t1.p0 AS p2 FROM t1 JOIN k1 USING (g)),
k2 AS (
  SELECT k1.*, s.S2, s.xs / s.S2 AS a2, s.S2 / k1.S1 AS b2, s.ys / s.S2 AS c2
  FROM k1 JOIN (SELECT g, sum(w * p2 * p2) AS S2, sum(w * x * p2 * p2) AS xs, sum(p2 * sy) AS ys
                FROM t2 GROUP BY g) s USING (g)),
t3 AS (SELECT t2.*, (t2.x - k2.a2) * t2.p2 - k2.b2 * t2.p1 AS p3 FROM t2 JOIN k2 USING (g)),
k3 AS (
  SELECT k2.*, s.S3, s.xs / s.S3 AS a3, s.S3 / k2.S2 AS b3, s.ys / s.S3 AS c3
  FROM k2 JOIN (SELECT g, sum(w * p3 * p3) AS S3, sum(w * x * p3 * p3) AS xs, sum(p3 * sy) AS ys
                FROM t3 GROUP BY g) s USING (g)),
t4 AS (SELECT t3.*, (t3.x - k3.a3) * t3.p3 - k3.b3 * t3.p2 AS p4 FROM t3 JOIN k3 USING (g)),
k4 AS (
  SELECT k3.*, s.S4, s.ys / s.S4 AS c4
  FROM k3 JOIN (SELECT g, sum(w * p4 * p4) AS S4, sum(p4 * sy) AS ys FROM t4 GROUP BY g) s USING (g)),
yh AS (
  SELECT t4.g, t4.w, t4.sy, t4.syy, k4.m,
    k4.c0 + k4.c1 * p1 AS y1,
    k4.c0 + k4.c1 * p1 + k4.c2 * p2 AS y2,
    k4.c0 + k4.c1 * p1 + k4.c2 * p2 + k4.c3 * p3 AS y3,
    k4.c0 + k4.c1 * p1 + k4.c2 * p2 + k4.c3 * p3 + k4.c4 * p4 AS y4
  FROM t4 JOIN k4 USING (g)),
sse AS (
  SELECT g, sum(w) AS n, max(m) AS m,
    sum(syy - 2 * y1 * sy + w * y1 * y1) AS e1, sum(syy - 2 * y2 * sy + w * y2 * y2) AS e2,
    sum(syy - 2 * y3 * sy + w * y3 * y3) AS e3, sum(syy - 2 * y4 * sy + w * y4 * y4) AS e4
  FROM yh GROUP BY g),
rm AS (
  SELECT g AS l_returnflag, d AS degree,
    CASE WHEN m >= d + 1 THEN sqrt(greatest(CASE d WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 ELSE e4 END, 0.0) / n) END AS rmse
  FROM sse, (SELECT unnest([1, 2, 3, 4]) AS d) ds),
best AS (
  SELECT l_returnflag, arg_min(degree, (rmse, degree)) AS best_degree, min(rmse) AS rmse
  FROM rm WHERE rmse IS NOT NULL GROUP BY l_returnflag)"""

QUALITY = """{geo}, q AS (
  SELECT g.state, g.county, count(*) AS n_customers,
    floor((2 * sum(round(c.c_acctbal * 100)::BIGINT) + count(*))::DOUBLE / (2 * count(*))) / 100.0 AS avg_acctbal, round(min(c.c_acctbal), 2) AS min_acctbal,
    round(max(c.c_acctbal), 2) AS max_acctbal,
    count(*) FILTER (WHERE c.c_mktsegment = 'BUILDING') AS n_building
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY ALL)""".format(geo=GEO)


# the commute modes of the stand-in place, and the segment that plays each
MODES = list(zip(("car", "public", "bicycle", "walk", "wfh"), (x.lower() for x in standin_files.SEGMENTS)))

ORACLES: dict[str, str] = {
    "src_text_lines": "SELECT o_orderkey, o_orderstatus FROM orders",
    "src_csv_multiline": "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations",
    "drop_header_row": "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part",
    "skip_first_rows": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "row_range_slice": """
      SELECT row_idx, o_orderkey, o_orderstatus FROM (
        SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx, o_orderkey, o_orderstatus FROM orders)
      WHERE row_idx >= 4 AND row_idx < 46""",
    "dataset_catalog": """
      SELECT 'region' AS dataset, count(*) AS n_rows, count(DISTINCT r_regionkey) AS n_keys FROM region
      UNION ALL SELECT 'nation', count(*), count(DISTINCT n_nationkey) FROM nation
      UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey) FROM customer
      UNION ALL SELECT 'supplier', count(*), count(DISTINCT s_suppkey) FROM supplier
      UNION ALL SELECT 'part', count(*), count(DISTINCT p_partkey) FROM part
      UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
      UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem
      UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events""",
    "inline_table": """
      WITH places(nationkey, place, state, all_residential) AS (VALUES
        (0, 'denver', 'colorado', 211215), (1, 'jefferson', 'colorado', 133042),
        (2, 'weld', 'colorado', 117564), (3, 'dallas', 'texas', 633113),
        (4, 'detroit', 'michigan', 227204), (5, 'houston', 'texas', 1208766),
        (6, 'placer', 'california', 138991)),
      per AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey)
      SELECT place, state, cast(all_residential AS BIGINT) AS all_residential,
             cast(coalesce(per.n, 0) AS BIGINT) AS n_customers
      FROM places LEFT JOIN per ON places.nationkey = per.c_nationkey""",
    "parse_result_lines": """
      SELECT n.n_name, count(*) AS total, count(*) FILTER (WHERE o.o_orderstatus = 'O') AS open
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      GROUP BY n.n_name""",
    "record_block_pivot": f"""
      WITH per AS (SELECT c_nationkey, count(*) AS n, {money_sum("c_acctbal")} AS s,
                          min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer GROUP BY c_nationkey)
      SELECT cast(row_number() OVER (ORDER BY n.n_nationkey) - 1 AS BIGINT) AS record, n.n_name,
             per.n AS n_customers, per.s AS sum_acctbal, per.lo AS min_acctbal, per.hi AS max_acctbal
      FROM nation n LEFT JOIN per ON n.n_nationkey = per.c_nationkey""",
    "sink_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "sink_single_file": f"""
      SELECT c_nationkey, count(*) AS n, {money_sum("c_acctbal")} AS total_acctbal
      FROM customer GROUP BY c_nationkey""",
    "sink_csv_header": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "count_report_with_total": """
      SELECT CASE WHEN grouping(p_type) = 1 THEN 'Total' ELSE p_type END AS p_type, count(*) AS n
      FROM part GROUP BY ROLLUP (p_type)""",
    "split_pick": "SELECT p_partkey, p_name, p_size FROM part",
    "split_quoted": """
      SELECT c_custkey, c_name || ', ' || c_mktsegment AS name_seg, c_acctbal,
             NULL::VARCHAR AS last_field, 5::BIGINT AS n_fields, 3::BIGINT AS n_fields_trimmed FROM customer""",
    "pick_by_position": "SELECT c_custkey, c_acctbal FROM customer",
    "null_label": """
      SELECT coalesce(CASE WHEN p_size >= 10 THEN p_brand END, 'null') AS label, count(*) AS n
      FROM part GROUP BY 1""",
    "lower_label": "SELECT lower(c_mktsegment) AS segment, count(*) AS n FROM customer GROUP BY 1",
    "tag_source": """
      SELECT s_suppkey AS id, s_acctbal AS acctbal, 'supplier' AS source FROM supplier
      UNION ALL SELECT c_custkey, c_acctbal, 'customer' FROM customer""",
    "clean_key": """
      SELECT c.c_custkey, substr(r.r_name, 1, 2) AS state, lower(n.n_name) AS county
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "strip_quotes": "SELECT o_orderkey, o_orderstatus FROM orders",
    "parse_int": "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS p_size FROM part",
    "parse_double": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer",
    "occupancy_share": f"""
      WITH {GEO}
      SELECT g.county, count(*) AS total,
        {_r("count(*) FILTER (WHERE o.o_orderstatus = 'F')::DOUBLE / count(*)", "occupied_share")},
        {_r("count(*) FILTER (WHERE o.o_orderstatus <> 'F')::DOUBLE / count(*)", "vacant_share")}
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey
      GROUP BY g.county""",
    "estimate_margin": f"""
      WITH {GEO}, a AS (
        SELECT g.county,
               floor((2 * sum(round(c.c_acctbal * 100)::BIGINT) + count(*))::DOUBLE / (2 * count(*))) / 100.0 AS estimate,
               round(stddev_samp(c.c_acctbal), 2) AS margin
        FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY g.county)
      SELECT county, estimate, margin, printf('%.2f', estimate) || '±' || printf('%.2f', margin) AS text FROM a""",
    "commute_modes": f"WITH {USER_MODES} SELECT * FROM um",
    "race_shares": f"""
      WITH {GEO}
      SELECT g.county,
        {_r("100.0 * count(*) FILTER (WHERE c.c_mktsegment = 'AUTOMOBILE') / count(*)", "automobile_pct")},
        {_r("100.0 * count(*) FILTER (WHERE c.c_mktsegment = 'BUILDING') / count(*)", "building_pct")},
        {_r("100.0 * count(*) FILTER (WHERE c.c_mktsegment = 'FURNITURE') / count(*)", "furniture_pct")},
        {_r("100.0 * count(*) FILTER (WHERE c.c_mktsegment = 'HOUSEHOLD') / count(*)", "household_pct")}
      FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY g.county""",
    "single_measure": f"""
      SELECT c_nationkey, {_r("quantile_cont(c_acctbal, 0.5)", "median_acctbal")}
      FROM customer GROUP BY c_nationkey""",
    "quality_array": f"""
      SELECT c_nationkey, {_r("count(*)", "n_customers")}, {_r(money_avg("c_acctbal"), "avg_acctbal")},
        {_r("min(c_acctbal)", "min_acctbal")}, {_r("max(c_acctbal)", "max_acctbal")},
        {_r(money_sum("c_acctbal"), "sum_acctbal")}
      FROM customer GROUP BY c_nationkey""",
    "strip_suffix": """
      SELECT c.c_custkey, lower(n.n_name) AS county FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "sentinel_zero": f"""
      SELECT c_mktsegment, {_r("sum(CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END)", "total_acctbal")}
      FROM customer GROUP BY c_mktsegment""",
    "share_with_guard": f"""
      WITH {USER_MODES}
      SELECT user_id, {_r("click::DOUBLE / coalesce(CASE WHEN user_id % 10 = 0 THEN NULL ELSE total END, 1)", "click_share")}
      FROM um""",
    "mode_share": f"""
      WITH {USER_MODES}
      SELECT user_id, {_r("click::DOUBLE / total", "click_share")}, {_r("view::DOUBLE / total", "view_share")},
        {_r("purchase::DOUBLE / total", "purchase_share")}, {_r("error::DOUBLE / total", "error_share")}
      FROM um""",
    "percent_text": f"SELECT l_orderkey, l_linenumber, {_r('l_discount', 'l_discount')} FROM lineitem",
    "currency_text": f"SELECT o_orderkey, {_r('o_totalprice', 'o_totalprice', 2)} FROM orders",
    "ratio_text": f"SELECT p_partkey, {_r('p_size', 'rate')} FROM part",
    "first_match_in_array": """
      WITH h AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)
      SELECT p_brand, min(p_type) FILTER (WHERE contains(p_type, 'AR')) AS first_type,
             arg_min(n, p_type) FILTER (WHERE contains(p_type, 'AR')) AS n
      FROM h GROUP BY p_brand""",
    "housing_mix": f"""
      WITH {MIX}
      SELECT state, county, all_residential, sf_residential, multi_residential,
        {_r("percent_residential", "percent_residential")}, {_r("percent_multi", "percent_multi")} FROM mix""",
    "keyword_any_filter": """
      SELECT p_partkey, p_name FROM part
      WHERE contains(p_name, 'old') OR contains(p_name, 'ring') OR contains(p_name, 'gear')""",
    "prefix_filter": "SELECT o_orderkey, o_orderpriority FROM orders WHERE starts_with(o_orderpriority, '5')",
    "prefix_any_filter": """
      SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2')""",
    "key_in_set": """
      SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE n.n_name IN ('NATION_1', 'NATION_3', 'NATION_7')""",
    "numeric_threshold": f"""
      WITH {MIX}
      SELECT state, county, all_residential, sf_residential, multi_residential,
        {_r("percent_residential", "percent_residential")}, {_r("percent_multi", "percent_multi")}
      FROM mix WHERE percent_residential > 0.125""",
    "nonzero_mask": f"""
      WITH {USER_MODES},
      l AS (UNPIVOT (SELECT user_id, click, view, purchase, signup, error FROM um)
            ON click, view, purchase, signup, error INTO NAME event_type VALUE cnt)
      SELECT event_type, {_r("avg(cnt)", "mean_nonzero")}, count(*) AS n_nonzero
      FROM l WHERE cnt <> 0 GROUP BY event_type""",
    "left_join_default": f"""
      WITH h AS (SELECT s_nationkey, floor(s_acctbal / 1000.0)::BIGINT AS band, avg(s_acctbal) AS health FROM supplier GROUP BY ALL)
      SELECT c.c_nationkey, c.c_custkey, floor(c.c_acctbal / 1000.0)::BIGINT AS band, {_r("coalesce(h.health, 0.0)", "health")}
      FROM customer c LEFT JOIN h ON c.c_nationkey = h.s_nationkey AND floor(c.c_acctbal / 1000.0)::BIGINT = h.band""",
    "lookup_update": f"""
      WITH cn AS (SELECT c.c_custkey, c.c_acctbal, n.n_regionkey AS state, 'c' || cast(n.n_nationkey % 5 AS VARCHAR) AS county
                  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
      base AS (SELECT state, county, floor(c_acctbal / 1000.0)::BIGINT AS band, count(*)::DOUBLE AS value FROM cn GROUP BY ALL),
      upd AS (SELECT cn.state, cn.county, floor(o.o_totalprice / 1000.0)::BIGINT AS band, arg_max(o.o_totalprice, o.o_orderkey) AS value
              FROM orders o JOIN cn ON o.o_custkey = cn.c_custkey GROUP BY ALL)
      SELECT base.state, base.county, base.band, {_r("coalesce(upd.value, base.value)", "value")}
      FROM base LEFT JOIN upd USING (state, county, band)""",
    "feature_table": f"""
      WITH {FEATURE_CTE}
      SELECT state, county, all_residential, sf_residential, multi_residential,
        {", ".join(_r(f, f) for f in FEATURES[3:])} FROM ft""",
    "count_by_value": f"WITH {PARCEL_COUNTS} SELECT label, cast(sum(n) AS BIGINT) AS n FROM pc GROUP BY label",
    "count_per_key": f"""
      WITH {GEO}
      SELECT g.county, count(*) AS n FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY g.county""",
    "histogram_per_key": f"WITH {PARCEL_COUNTS} SELECT county, label, n FROM pc",
    "group_values": """
      SELECT p_type, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands
      FROM part WHERE p_brand IS NOT NULL GROUP BY p_type""",
    "histogram_filtered": """
      WITH h AS (SELECT p_brand, p_type, count(*) AS n FROM part
                 WHERE substr(p_type, 1, 3) IN ('PRO', 'SMA') GROUP BY ALL),
      k AS (SELECT DISTINCT p_brand FROM part)
      SELECT k.p_brand, h.p_type, coalesce(h.n, 0) AS n FROM k LEFT JOIN h USING (p_brand)""",
    "histogram_total": """
      WITH h AS (SELECT p_brand, count(*) AS n FROM part WHERE substr(p_type, 1, 3) IN ('PRO', 'SMA') GROUP BY ALL),
      k AS (SELECT DISTINCT p_brand FROM part)
      SELECT k.p_brand, cast(coalesce(h.n, 0) AS BIGINT) AS total FROM k LEFT JOIN h USING (p_brand)""",
    "distinct_values": "SELECT DISTINCT p_type FROM part",
    "describe_nonzero": f"""
      WITH {FEATURE_LONG}
      SELECT feature, count(*) AS count, {_r("avg(value)", "mean")}, {_r("stddev_samp(value)", "std")},
        {_r("min(value)", "min")}, {_r("quantile_cont(value, 0.25)", "p25")},
        {_r("quantile_cont(value, 0.5)", "p50")}, {_r("quantile_cont(value, 0.75)", "p75")},
        {_r("max(value)", "max")}
      FROM fl WHERE value IS NOT NULL AND value <> 0 GROUP BY feature""",
    "explode_filtered": """
      SELECT DISTINCT p_brand, lower(concat_ws(' ', p_type, p_name)) AS label FROM part
      WHERE contains(lower(concat_ws(' ', p_type, p_name)), 'ring') AND p_brand IS NOT NULL""",
    "union_sources": """
      SELECT p_partkey, lower(concat_ws(' ', p_type, p_name)) AS label, 'small' AS source FROM part WHERE p_size <= 10
      UNION ALL SELECT p_partkey, lower(concat_ws(' ', p_type, p_name)), 'medium' FROM part WHERE p_size BETWEEN 11 AND 30
      UNION ALL SELECT p_partkey, lower(concat_ws(' ', p_type, p_name)), 'large' FROM part WHERE p_size IS NULL OR p_size > 30""",
    "zip_columns": """
      WITH h AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL)
      SELECT p_type, cast(row_number() OVER (PARTITION BY p_type ORDER BY p_brand, n) - 1 AS BIGINT) AS pos, p_brand, n
      FROM h""",
    "unpivot_features": f"WITH {FEATURE_LONG} SELECT state, county, feature, {_r('value', 'value')} FROM fl",
    "sort_by_key": f"""
      WITH {PARCEL_COUNTS}, c AS (SELECT label, cast(sum(n) AS BIGINT) AS n FROM pc GROUP BY label)
      SELECT label, n, row_number() OVER (ORDER BY label) AS rank FROM c""",
    "top_k_single": f"""
      WITH {MIX}
      SELECT state, county, all_residential, sf_residential, multi_residential,
        {_r("percent_residential", "percent_residential")}, {_r("percent_multi", "percent_multi")}
      FROM mix ORDER BY percent_residential DESC, state, county LIMIT 5""",
    "top_k_multi": f"""
      WITH {MIX}
      SELECT state, county, all_residential, sf_residential, multi_residential,
        {_r("percent_residential", "percent_residential")}, {_r("percent_multi", "percent_multi")}
      FROM mix ORDER BY percent_multi DESC, state, county LIMIT 5""",
    "render_record": f"""
      WITH {QUALITY}
      SELECT county, county || chr(10) || chr(9) || 'customers:' || cast(n_customers AS VARCHAR)
        || chr(10) || chr(9) || 'avgBalance:' || printf('%.2f', avg_acctbal)
        || chr(10) || chr(9) || 'minBalance:' || printf('%.2f', min_acctbal)
        || chr(10) || chr(9) || 'maxBalance:' || printf('%.2f', max_acctbal)
        || chr(10) || chr(9) || 'building:' || cast(n_building AS VARCHAR) AS record
      FROM q""",
    "zscore": f"""
      WITH {CUST_Z}
      SELECT c_custkey, {", ".join(_r(f, f) for f in CUST_FEATURES)} FROM z""",
    "kmeans_sse_k1": f"""
      WITH {CUST_Z}
      SELECT round(sum({" + ".join(f"{f} * {f}" for f in CUST_FEATURES)}), 2) AS sse FROM z""",
    "kmeans_one_step": f"""
      WITH {CUST_Z},
      c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS j, * FROM (SELECT * FROM z ORDER BY c_custkey LIMIT 6)),
      dist AS (
        SELECT z.c_custkey, c.j, {" + ".join(f"(z.{f} - c.{f}) * (z.{f} - c.{f})" for f in CUST_FEATURES)} AS d
        FROM z, c),
      asg AS (SELECT c_custkey, arg_min(j, (d, j)) AS cluster FROM dist GROUP BY c_custkey)
      SELECT cast(asg.cluster AS INTEGER) AS cluster, count(*) AS n, {", ".join(_r(f"avg(z.{f})", f) for f in CUST_FEATURES)}
      FROM asg JOIN z USING (c_custkey) GROUP BY asg.cluster""",
    "kmeans_fixed_sse": f"""
      WITH {CUST_Z},
      c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS j, * FROM (SELECT * FROM z ORDER BY c_custkey LIMIT 6)),
      dist AS (
        SELECT z.c_custkey, m.k, c.j, {" + ".join(f"(z.{f} - c.{f}) * (z.{f} - c.{f})" for f in CUST_FEATURES)} AS d
        FROM z, c, (VALUES (2), (4), (6)) m(k) WHERE c.j < m.k),
      asg AS (SELECT c_custkey, k, arg_min(j, (d, j)) AS cluster, min(d) AS d FROM dist GROUP BY c_custkey, k)
      SELECT k, cast(cluster AS INTEGER) AS cluster, count(*) AS n, {_r("sum(d)", "sse")}
      FROM asg GROUP BY k, cluster""",
    "linear_fit": f"""
      SELECT l_returnflag, count(*) AS n,
        {_r("regr_slope(l_extendedprice, l_quantity)", "slope")},
        {_r("regr_intercept(l_extendedprice, l_quantity)", "intercept")},
        {_r("corr(l_quantity, l_extendedprice)", "corr")},
        {_r("regr_r2(l_extendedprice, l_quantity)", "r2")}
      FROM lineitem GROUP BY l_returnflag""",
    "poly_fit_rmse": f"WITH {POLY} SELECT l_returnflag, degree, {sig('rmse')} AS rmse FROM rm",
    "poly_best_degree": f"WITH {POLY} SELECT l_returnflag, best_degree, {sig('rmse')} AS rmse FROM best",
    "fit_curve_grid": f"""
      WITH {POLY},
      gr AS (
        SELECT k4.*, best.best_degree, i,
          CASE WHEN i = 999 THEN xmax ELSE xmin + i::DOUBLE * ((xmax - xmin) / 999.0) END AS gx
        FROM k4 JOIN best ON k4.g = best.l_returnflag, range(0, 1000) r(i)),
      pv AS (
        SELECT *, gx - a0 AS q1 FROM gr),
      pv2 AS (SELECT *, (gx - a1) * q1 - b1 * 1.0 AS q2 FROM pv),
      pv3 AS (SELECT *, (gx - a2) * q2 - b2 * q1 AS q3 FROM pv2),
      pv4 AS (SELECT *, (gx - a3) * q3 - b3 * q2 AS q4 FROM pv3)
      SELECT g AS l_returnflag, cast(i AS INTEGER) AS i, {sig("gx")} AS x,
        {sig("c0 + CASE WHEN best_degree >= 1 THEN c1 * q1 ELSE 0 END"
             " + CASE WHEN best_degree >= 2 THEN c2 * q2 ELSE 0 END"
             " + CASE WHEN best_degree >= 3 THEN c3 * q3 ELSE 0 END"
             " + CASE WHEN best_degree >= 4 THEN c4 * q4 ELSE 0 END")} AS y
      FROM pv4""",
    "share_vs_feature": f"""
      WITH {FEATURE_CTE},
      sv AS (SELECT * FROM ft WHERE percent_residential > 0.125),
      fl AS (UNPIVOT (SELECT state, county, percent_residential::DOUBLE AS percent_residential,
                      {", ".join(f"{f}::DOUBLE AS {f}" for f in FEATURES if f != "percent_residential")} FROM sv)
             ON {", ".join(f for f in FEATURES if f != "percent_residential")} INTO NAME feature VALUE value)
      SELECT state, county, {_r("percent_residential", "percent_residential")}, feature, {_r("value", "value")}
      FROM fl WHERE value IS NOT NULL AND value <> 0""",
    "analysis_summary": f"""
      WITH {ANALYSIS},
      fl AS (UNPIVOT (SELECT state, county, {", ".join(f"{f}::DOUBLE AS {f}" for f in FEATURES)} FROM an)
             ON {", ".join(FEATURES)} INTO NAME feature VALUE value)
      SELECT feature, count(*) AS count, {_r("avg(value)", "mean")}, {_r("stddev_samp(value)", "std")},
        {_r("min(value)", "min")}, {_r("quantile_cont(value, 0.25)", "p25")},
        {_r("quantile_cont(value, 0.5)", "p50")}, {_r("quantile_cont(value, 0.75)", "p75")},
        {_r("max(value)", "max")}
      FROM fl WHERE value IS NOT NULL AND value <> 0 GROUP BY feature""",
    "analysis_top": f"""
      WITH {ANALYSIS}
      SELECT * FROM (SELECT state, county, {_r("percent_residential", "percent_residential")},
        {_r("percent_multi", "percent_multi")}, 'single' AS ranking FROM an ORDER BY an.percent_residential DESC, state, county LIMIT 5)
      UNION ALL
      SELECT * FROM (SELECT state, county, {_r("percent_residential", "percent_residential")},
        {_r("percent_multi", "percent_multi")}, 'multi' AS ranking FROM an ORDER BY an.percent_multi DESC, state, county LIMIT 5)""",
    "analysis_pairs": f"""
      WITH {ANALYSIS}
      SELECT state, county, {_r("percent_residential", "percent_residential")}, feature, {_r("value", "value")}, cluster
      FROM pairs""",
    "analysis_linear": f"""
      WITH {ANALYSIS}
      SELECT feature, count(*) AS n, {_r("regr_slope(value, percent_residential)", "slope")},
        {_r("regr_intercept(value, percent_residential)", "intercept")},
        {_r("corr(percent_residential, value)", "corr")}, {_r("regr_r2(value, percent_residential)", "r2")}
      FROM pairs GROUP BY feature""",
    "residential_profile": f"""
      WITH {LABELS},
      r AS (SELECT l.l_returnflag AS source, lab.label FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
            JOIN nation n ON s.s_nationkey = n.n_nationkey
            JOIN lab ON l.l_partkey = lab.p_partkey WHERE {RES}),
      h AS (SELECT source, label, count(*) AS n FROM r GROUP BY ALL),
      t AS (SELECT source, count(*) AS key_total FROM r GROUP BY ALL)
      SELECT h.source, h.label, h.n, t.key_total FROM h JOIN t USING (source)""",
    "residential_by_code": f"""
      WITH {GEO},
      o AS (SELECT g.county, o.o_orderpriority FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
            JOIN geo g ON c.c_nationkey = g.n_nationkey WHERE substr(o.o_orderpriority, 1, 1) IN ('1', '2', '3')),
      h AS (SELECT county, o_orderpriority AS code, count(*) AS n FROM o GROUP BY ALL),
      t AS (SELECT county, sum(n) AS kept_total FROM h WHERE substr(code, 1, 3) IN ('1-U', '2-H') GROUP BY ALL)
      SELECT h.county, h.code, h.n, cast(coalesce(t.kept_total, 0) AS BIGINT) AS kept_total
      FROM h LEFT JOIN t USING (county)""",
    "city_label_counts": f"""
      WITH {LABELS},
      c AS (SELECT lab.label, count(*) AS n FROM lineitem l JOIN lab ON l.l_partkey = lab.p_partkey GROUP BY ALL)
      SELECT CASE WHEN grouping(label) = 1 THEN 'Total' ELSE label END AS label, cast(sum(n) AS BIGINT) AS n,
             'all' AS report FROM c GROUP BY ROLLUP (label)
      UNION ALL
      SELECT CASE WHEN grouping(label) = 1 THEN 'Total' ELSE label END, cast(sum(n) AS BIGINT), 'residential'
      FROM c WHERE {RES} GROUP BY ROLLUP (label)""",
    "quality_of_life": f"""
      WITH {QUALITY},
      h AS (SELECT g.state, g.county, avg(s.s_acctbal) AS mental_health FROM supplier s
            JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY ALL)
      SELECT q.state, q.county, q.n_customers, q.avg_acctbal, q.min_acctbal, q.max_acctbal, q.n_building,
             {_r("coalesce(h.mental_health, 0.0)", "mental_health")}
      FROM q LEFT JOIN h USING (state, county)""",
    "place_label_report": """
      WITH r AS (SELECT lower(c_mktsegment) AS label, count(*) AS n FROM customer GROUP BY ALL),
      a AS (SELECT 'all' AS report, label, n FROM r
            UNION ALL SELECT 'residential', label, n FROM r WHERE contains(label, 'building') OR contains(label, 'house'))
      SELECT report, label, n FROM a
      UNION ALL SELECT report, 'Total', cast(sum(n) AS BIGINT) FROM a GROUP BY report""",
    "place_county_labels": """
      SELECT 'standin' AS state, lower(n_name) AS county, lower(c_mktsegment) AS label, count(*) AS n
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD') GROUP BY ALL""",
    "place_measures": f"""
      WITH {standin_files.PER_SQL}
      SELECT 'standin' AS state, county, cast(n AS DOUBLE) AS commuters,
        {", ".join(_r(f"{seg} / n::DOUBLE", f"percentage_{m}") for m, seg in MODES)},
        {_r("(n % 30) / 100.0::DOUBLE", "owner_below_poverty")}, {_r("(n % 50) / 100.0::DOUBLE", "renter_below_poverty")},
        {_r("(n % 4) / 100.0::DOUBLE", "owner_poverty_margin")}, {_r("(n % 5) / 100.0::DOUBLE", "renter_poverty_margin")},
        {_r("cast(n % 40 AS DOUBLE)", "crime_rate")}, {_r("(n % 8 + 0.25::DOUBLE) / 100", "unemployment")},
        n % 3 AS "nationalParkCount", {_r("(n % 6 + 0.5::DOUBLE) / 100", "stateParkCoverage")},
        {_r("cast(n * 10 AS DOUBLE)", "costOfLiving")}, {_r("n % 9 + 0.5::DOUBLE", "mentalHealth")}
      FROM per WHERE n > 0""",
    "place_features": f"""
      WITH {standin_files.PER_SQL},
      f AS (SELECT *, building + household AS all_r FROM per WHERE building + household > 0)
      SELECT 'standin' AS state, county, 'county' AS level, all_r AS all_residential,
        household AS sf_residential, all_r - household AS multi_residential,
        {_r("household / all_r::DOUBLE", "percent_residential")}, {_r("(all_r - household) / all_r::DOUBLE", "percent_multi")},
        cast(n % 60 AS DOUBLE) AS commute_time_in_mins,
        {", ".join(_r(f"{seg} / n::DOUBLE", f"percentage_{m}") for m, seg in MODES if m != "bicycle")},
        {_r("(n - in_debt) / n::DOUBLE", "percentage_occupancy")}, {_r("in_debt / n::DOUBLE", "percentage_vacant")},
        {_r("(n % 30) / 100.0::DOUBLE", "owner_below_poverty")}, {_r("(n % 50) / 100.0::DOUBLE", "renter_below_poverty")},
        {_r("cast(n % 40 AS DOUBLE)", "crime_rate")}, {_r("(n % 8 + 0.25::DOUBLE) / 100", "unemployment")},
        {_r("cast(n * 10 AS DOUBLE)", "costOfLiving")}, {_r("n % 9 + 0.5::DOUBLE", "mentalHealth")},
        {_r("cast(n * 100 AS DOUBLE)", "median_income")},
        {", ".join(_r(f"cast(n % {20 + i} AS DOUBLE)", c) for i, c in enumerate(RACE))}
      FROM f""",
}
