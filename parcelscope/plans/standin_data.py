"""Stand-ins for the reference's inputs, derived from the driver's tables.

The driver's tables have no parcels or census files, so each role is played
by a view of the same shape (see SURVEY section 7.2):

* parcels (state, county, label): one parcel per ``lineitem`` row; county is
  the supplier's nation, state its region, label ``lower(p_type || ' ' ||
  p_name)``;
* per-county measures: aggregates of ``customer`` / ``orders`` / ``supplier``
  per nation;
* a county spine: ``nation`` joined with ``region``.

Everything reads only the columns it needs, so the Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.operators import filters as flt

# Fixed values for the stand-in label rules (configuration, like a place's
# word list): a "residential" label holds any of these words ...
RESIDENTIAL_WORDS = ("old", "ring", "gear")
# ... and a "single family" label holds this one.
SINGLE_WORD = "ring"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def geo(spark: SparkSession, d: str) -> DataFrame:
    """County spine: (nationkey, state, county)."""
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region", "r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select("n_nationkey", F.lower("r_name").alias("state"), F.lower("n_name").alias("county")))


def part_labels(spark: SparkSession, d: str, words=None) -> DataFrame:
    """(p_partkey, label), optionally only labels holding one of ``words``."""
    p = table(spark, d, "part", "p_partkey", "p_type", "p_name")
    out = p.select("p_partkey", F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("label"))
    return out.filter(flt.keyword_any("label", words)) if words else out


def parcel_counts(spark: SparkSession, d: str, words=None, by: list[str] | None = None,
                  by_nation_key: bool = False) -> DataFrame:
    """Parcels counted per ([by...], state, county, label): (..., n).

    ``by`` are extra lineitem columns kept as keys (e.g. ``l_returnflag``).
    Aggregated before each join: lineitems are first counted per
    (by, supplier, part) (map-side partial aggregation), then per (by, supplier
    nation, part), then per (by, nation, label), so the joins with
    ``supplier``, ``part`` and the county spine see pre-aggregated rows, not
    lineitems. A residential word list filters ``part`` before its join.
    ``by_nation_key`` returns the nation key ``nk`` instead of joining the
    county spine (for callers that attach it once, at the end).
    """
    by = list(by or [])
    li = table(spark, d, "lineitem", "l_partkey", "l_suppkey", *by)
    per_supp = li.groupBy(*by, "l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    s = table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    per_part = (per_supp.join(s, per_supp.l_suppkey == s.s_suppkey)
                .groupBy(*by, "s_nationkey", "l_partkey").agg(F.sum("n").alias("n")))
    labels = part_labels(spark, d, words)
    per_label = (per_part.join(labels, per_part.l_partkey == labels.p_partkey)
                 .groupBy(*by, "s_nationkey", "label").agg(F.sum("n").alias("n")))
    if by_nation_key:
        return per_label.select(*by, F.col("s_nationkey").alias("nk"), "label",
                                F.col("n").cast("long").alias("n"))
    g = geo(spark, d)
    return (per_label.join(g, per_label.s_nationkey == g.n_nationkey)
            .select(*by, "state", "county", "label", F.col("n").cast("long").alias("n")))


def customer_geo(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Customers with their (state, county)."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", *cols)
    g = geo(spark, d)
    return c.join(g, c.c_nationkey == g.n_nationkey).drop("n_nationkey")


def order_counts(spark: SparkSession, d: str, col: str, keep=None) -> DataFrame:
    """Orders counted per (nation key of their customer, ``col``): counted per
    customer before the join, so a customer with many orders is a few rows."""
    o = table(spark, d, "orders", "o_custkey", col)
    o = o.filter(keep) if keep is not None else o
    per = o.groupBy("o_custkey", col).agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer", "c_custkey", "c_nationkey")
    return per.join(c, per.o_custkey == c.c_custkey).groupBy("c_nationkey", col).agg(F.sum("n").alias("n"))


def order_geo_counts(spark: SparkSession, d: str, col: str, keep=None) -> DataFrame:
    """(state, county, ``col``, n): orders counted per place of their customer."""
    per, g = order_counts(spark, d, col, keep), geo(spark, d)
    return per.join(g, per.c_nationkey == g.n_nationkey).select("state", "county", col, "n")


def customer_features(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer: balance and order behaviour (0 when no orders).

    Orders are aggregated per customer first, then left-joined.
    """
    c = table(spark, d, "customer", "c_custkey", "c_acctbal")
    o = table(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderpriority")
    per = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.sum("o_totalprice").alias("total_price"),
        F.avg("o_totalprice").alias("avg_price"),
        F.avg(F.when(F.col("o_orderpriority").startswith("1"), 1.0).otherwise(0.0)).alias("urgent_share"))
    out = c.join(per, c.c_custkey == per.o_custkey, "left").drop("o_custkey")
    return out.fillna(0.0, subset=["n_orders", "total_price", "avg_price", "urgent_share"])


CUSTOMER_FEATURES = ["c_acctbal", "n_orders", "total_price", "avg_price", "urgent_share"]
