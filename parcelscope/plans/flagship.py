"""E9 flagship: feature table -> one linear fit per feature against the
single-family share (the reference's "share vs quality" question)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelscope.operators import stats
from parcelscope.plans import features as feat


def feature_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ft = feat.county_features(spark, sf_dir)
    others = [f for f in feat.FEATURES if f != "percent_residential"]
    pairs = stats.share_vs_feature(ft, feat.KEY, "percent_residential", others)
    return stats.linear_fit(pairs, ["feature"], "percent_residential", "value")
