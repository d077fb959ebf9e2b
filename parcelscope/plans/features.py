"""County feature table on the stand-in data (J3, E9's input).

One row per (state, county) of the spine. Every part is a per-nation
aggregate keyed by the nation key; they are left-joined to the spine, which
carries (state, county), so the county names are attached once. Missing
values become 0 (``zero_fill``), which is how the reference's table holds
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.functions.numbers import housing_mix, money_avg, money_cents, ratio
from parcelscope.operators.joins import assemble
from parcelscope.operators.ordering import exact_quantiles
from parcelscope.plans import standin_data as sd

KEY = ["state", "county"]
NK = "nk"  # nation key, the join key of the parts
FEATURES = [
    "all_residential", "sf_residential", "multi_residential", "percent_residential",
    "percent_multi", "occupied_share", "vacant_share", "avg_order_price", "mean_acctbal",
    "median_acctbal", "automobile_pct", "building_pct", "supplier_health",
]


def _with_names(spark: SparkSession, d: str, by_nk: DataFrame) -> DataFrame:
    """Replace the nation key by (state, county)."""
    g = sd.geo(spark, d).withColumnRenamed("n_nationkey", NK)
    return by_nk.join(g, NK).drop(NK).select(*KEY, *[c for c in by_nk.columns if c != NK])


def _mix_by_nation(spark: SparkSession, d: str) -> DataFrame:
    counts = sd.parcel_counts(spark, d, sd.RESIDENTIAL_WORDS, by_nation_key=True)
    agg = counts.groupBy(NK).agg(
        F.sum("n").cast("long").alias("all_residential"),
        F.sum(F.when(F.col("label").contains(sd.SINGLE_WORD), F.col("n")).otherwise(0))
        .cast("long").alias("sf_residential"))
    mix = housing_mix("all_residential", "sf_residential")
    return agg.select(NK, "all_residential", "sf_residential",
                      mix["multi"].alias("multi_residential"),
                      mix["single_share"].alias("percent_residential"),
                      mix["multi_share"].alias("percent_multi"))


def residential_mix(spark: SparkSession, d: str) -> DataFrame:
    """P24 per county: residential parcels, single-family ones, the rest, shares."""
    return _with_names(spark, d, _mix_by_nation(spark, d))


def _occupancy_by_nation(spark: SparkSession, d: str) -> DataFrame:
    """Order status shares; orders are aggregated per customer before the
    customer join (one row per customer instead of per order)."""
    o = sd.table(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice")
    per_cust = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("o_orderstatus") == "F").alias("occupied"),
        F.count_if(F.col("o_orderstatus") == "O").alias("vacant"),
        F.sum(money_cents("o_totalprice")).alias("cents"))
    c = sd.table(spark, d, "customer", "c_custkey", "c_nationkey")
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey)
    agg = j.groupBy(F.col("c_nationkey").alias(NK)).agg(
        F.sum("total").alias("total"), F.sum("occupied").alias("occupied"),
        F.sum("vacant").alias("vacant"), F.sum("cents").alias("cents"))
    return agg.select(NK, ratio("occupied", "total").alias("occupied_share"),
                      ratio("vacant", "total").alias("vacant_share"),
                      (F.col("cents").cast("double") / F.col("total").cast("double") / F.lit(100.0))
                      .alias("avg_order_price"))


def occupancy(spark: SparkSession, d: str) -> DataFrame:
    return _with_names(spark, d, _occupancy_by_nation(spark, d))


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return sd.table(spark, d, "customer", "c_nationkey", "c_acctbal", "c_mktsegment") \
        .withColumnRenamed("c_nationkey", NK)


def _customer_mix_by_nation(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).groupBy(NK).agg(
        money_avg("c_acctbal").alias("mean_acctbal"),
        (F.lit(100.0) * F.avg(F.when(F.col("c_mktsegment") == "AUTOMOBILE", 1.0).otherwise(0.0))).alias("automobile_pct"),
        (F.lit(100.0) * F.avg(F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0))).alias("building_pct"))


def customer_mix(spark: SparkSession, d: str) -> DataFrame:
    return _with_names(spark, d, _customer_mix_by_nation(spark, d))


def _median_by_nation(spark: SparkSession, d: str) -> DataFrame:
    return exact_quantiles(_customers(spark, d), "c_acctbal", [0.5], [NK], names=["median_acctbal"])


def median_balance(spark: SparkSession, d: str) -> DataFrame:
    return _with_names(spark, d, _median_by_nation(spark, d))


def _health_by_nation(spark: SparkSession, d: str) -> DataFrame:
    s = sd.table(spark, d, "supplier", "s_nationkey", "s_acctbal")
    return s.groupBy(F.col("s_nationkey").alias(NK)).agg(money_avg("s_acctbal").alias("supplier_health"))


def supplier_health(spark: SparkSession, d: str) -> DataFrame:
    return _with_names(spark, d, _health_by_nation(spark, d))


def county_features(spark: SparkSession, d: str, zero_fill: bool = True) -> DataFrame:
    """The feature table: (state, county, <FEATURES>)."""
    spine = sd.geo(spark, d).select(F.col("n_nationkey").alias(NK), *KEY)
    parts = [_mix_by_nation(spark, d), _occupancy_by_nation(spark, d),
             _customer_mix_by_nation(spark, d), _median_by_nation(spark, d),
             _health_by_nation(spark, d)]
    out = assemble(spine, parts, [NK], None, zero_fill=zero_fill)
    return out.select(*KEY, *FEATURES)
