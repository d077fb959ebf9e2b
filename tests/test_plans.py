"""Plan-level checks (no execution of the heavy parts): what the optimizer
must keep doing for the queries to scale."""

import pytest

from parcelscope.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
EAGER = {"kmeans_elbow", "kmeans_assign"}  # fit models when called


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(q(spark, SF)) for name, q in QUERIES.items() if name not in EAGER}


def test_no_cross_joins_and_no_python(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_filters_reach_the_scan(plans):
    assert "StringStartsWith(o_orderpriority,5)" in plans["prefix_filter"]
    p = plans["prefix_any_filter"]
    assert "Or(StringStartsWith(p_brand,Brand#1),StringStartsWith(p_brand,Brand#2))" in p
    assert "In(n_name, [NATION_1,NATION_3,NATION_7])" in plans["key_in_set"]
    assert "StringContains(p_name,old)" in plans["keyword_any_filter"]


def test_scans_are_pruned(plans):
    assert "ReadSchema: struct<l_suppkey:bigint>" in plans["count_per_key"] or \
        "struct<l_suppkey:bigint>" in plans["count_per_key"]
    assert "struct<p_type:string>" in plans["distinct_values"]


def test_lineitem_is_aggregated_before_joins(spark):
    from parcelscope.plans import standin_data as sd
    p = sd.parcel_counts(spark, SF, sd.RESIDENTIAL_WORDS)._jdf.queryExecution().optimizedPlan().toString()
    # the innermost aggregate sits directly on the lineitem relation
    lines = [ln.strip() for ln in p.splitlines()]
    li = max(i for i, ln in enumerate(lines) if "l_partkey" in ln and "Relation" in ln)
    above = [ln for ln in lines[:li] if ln.lstrip("+-: ").startswith(("Aggregate", "Join"))]
    assert above[-1].lstrip("+-: ").startswith("Aggregate")
