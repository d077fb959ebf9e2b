"""Property tests for the invariants the reference's outputs satisfy
(SURVEY section 5): counts add up, histograms sum to key totals, occupancy
shares sum to 1, a left join keeps every row, quantiles match numpy."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelscope import functions as fn
from parcelscope.operators import aggregates as agg
from parcelscope.operators import joins
from parcelscope.operators.ordering import exact_quantiles

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

counties = st.sampled_from(["denver", "weld", "jefferson", "adams", "van wert"])
labels = st.sampled_from(["510: res-single family", "520: res-two family", "apt w/2 units",
                          "warehouse", "single family", "office"])


@settings(**SETTINGS)
@given(st.lists(st.tuples(counties, labels), min_size=1, max_size=300))
def test_counts_add_up(spark, rows):
    df = spark.createDataFrame(rows, "county string, label string")
    by_label = {r.label: r.n for r in agg.count_by_value(df, "label").collect()}
    by_key = {r.county: r.n for r in agg.count_per_key(df, "county").collect()}
    hist = agg.histogram_per_key(df, "county", "label")
    per_key_hist = {r.county: r.t for r in hist.groupBy("county").agg(F.sum("n").alias("t")).collect()}
    report = {r.label: r.n for r in agg.with_total_row(agg.count_by_value(df, "label"), "label").collect()}
    assert sum(by_label.values()) == sum(by_key.values()) == len(rows) == report["Total"]
    assert per_key_hist == by_key
    kept = agg.histogram_total(hist.filter(F.col("label").startswith("5")), "county")
    for r in kept.collect():
        assert r.total <= by_key[r.county]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 10_000), st.integers(0, 10_000)), min_size=1, max_size=50))
def test_occupancy_shares_sum_to_one(spark, rows):
    data = [(occ + vac, occ, vac) for occ, vac in rows]
    df = spark.createDataFrame(data, "total long, occupied long, vacant long")
    for r in df.select(fn.ratio("occupied", "total").alias("o"), fn.ratio("vacant", "total").alias("v")).collect():
        assert abs(r.o + r.v - 1.0) < 1e-12


@settings(**SETTINGS)
@given(st.lists(counties, min_size=1, max_size=40), st.lists(counties, max_size=5, unique=True))
def test_left_join_keeps_rows(spark, left_keys, right_keys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(left_keys)], "county string, id int")
    right = spark.createDataFrame([(k, 1.5) for k in right_keys], "county string, h double")
    out = joins.left_join_default(left, right, ["county"], {"h": 0.0}).collect()
    assert len(out) == len(left_keys)
    assert all((r.h == 1.5) == (r.county in right_keys) for r in out)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]),
                          st.one_of(st.just(7.0), st.floats(-1e6, 1e6, allow_nan=False))),
                min_size=1, max_size=200),
       st.lists(st.floats(0, 1), min_size=1, max_size=3))
def test_quantiles_match_numpy(spark, rows, qs):
    df = spark.createDataFrame(rows, "g string, v double")
    names = [f"q{i}" for i in range(len(qs))]
    got = {r.g: [r[n] for n in names] for r in exact_quantiles(df, "v", qs, ["g"], names).collect()}
    for g in {k for k, _ in rows}:
        vals = np.array([v for k, v in rows if k == g])
        assert np.allclose(got[g], np.quantile(vals, qs), rtol=1e-12, atol=1e-9)
