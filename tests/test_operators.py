"""Operators (F, A, R, J, M) against brute force on invented data."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelscope.operators import aggregates as agg
from parcelscope.operators import cluster, joins, reshape, stats
from parcelscope.operators import filters as flt
from parcelscope.operators.ordering import exact_quantiles, indexed_sort


def test_keyword_any_is_substring(spark):
    df = spark.createDataFrame([("warehouse",), ("greenhouse",), ("office",), ("single family",)], "l string")
    kept = {r.l for r in df.filter(flt.keyword_any("l", ["house", "family"])).collect()}
    assert kept == {"warehouse", "greenhouse", "single family"}
    assert df.filter(flt.keyword_any("l", [])).count() == 0


def test_prefix_filters(spark):
    df = spark.createDataFrame([("510: Single",), ("550: Condo",), ("599: Other",), ("410: Shop",)], "c string")
    assert df.filter(flt.prefix("c", "5")).count() == 3
    got = {r.c for r in df.filter(flt.prefix_any("c", ["510", "520", "530", "540", "550", "560"])).collect()}
    assert got == {"510: Single", "550: Condo"}
    assert df.filter(flt.prefix_any("c", ["41", "599"])).count() == 2


def test_counts_add_up(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["denver", "weld", "jefferson"]), rnd.choice(["house", "apt", "condo", "duplex"]))
            for _ in range(500)]
    df = spark.createDataFrame(rows, "county string, label string")
    by_label = agg.count_by_value(df, "label")
    by_key = agg.count_per_key(df, "county")
    hist = agg.histogram_per_key(df, "county", "label")
    total = sum(r.n for r in by_label.collect())
    assert total == sum(r.n for r in by_key.collect()) == 500
    per_key = {r.county: r.n for r in by_key.collect()}
    nested = agg.nest_histogram(hist, "county", "label")
    for r in nested.select("county", agg.nested_total("histogram").alias("t")).collect():
        assert r.t == per_key[r.county]
    rep = {r.label: r.n for r in agg.with_total_row(by_label, "label").collect()}
    assert rep["Total"] == 500


def test_histogram_filtered_keeps_empty_keys(spark):
    df = spark.createDataFrame([("a", "510 x"), ("a", "599 y"), ("b", "599 y")], "k string, code string")
    hist = agg.histogram_per_key(df, "k", "code")
    kept = agg.histogram_filtered(hist, df, "k", flt.prefix_any("code", ["510"]))
    tot = {r.k: r.total for r in agg.histogram_total(kept, "k").collect()}
    assert tot == {"a": 1, "b": 0}


def test_group_values_sorted_distinct(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "b"), ("b", None)], "k string, v string")
    got = {r.k: r.values for r in agg.group_values(df, "k", "v").collect()}
    assert got == {"a": ["b", "z"]}


def test_indexed_sort_global_and_grouped(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 5)}", rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    glob = indexed_sort(df, ["v"], index_col="i").collect()
    assert sorted(r.i for r in glob) == list(range(2000))
    assert all(a.v <= b.v for a, b in zip(sorted(glob, key=lambda r: r.i), sorted(glob, key=lambda r: r.i)[1:]))
    grp = indexed_sort(df, [F.desc("v")], ["g"], index_col="i", num_partitions=5).toPandas()
    for _, part in grp.groupby("g"):
        part = part.sort_values("i")
        assert list(part.i) == list(range(len(part)))
        assert part.v.is_monotonic_decreasing


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(5)
    g = np.where(rnd.random(3001) < 0.4, "hot", rnd.choice(["a", "b", "c"], 3001))
    v = rnd.normal(size=3001)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    qs = [0.25, 0.5, 0.75]
    got = {r.g: (r.q25, r.q50, r.q75) for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for key in np.unique(g):
        want = np.quantile(v[g == key], qs)
        assert np.allclose(got[key], want, rtol=0, atol=1e-12)
    whole = exact_quantiles(df, "v", [0.5]).first()
    assert abs(whole.q50 - np.median(v)) < 1e-12


def test_describe_nonzero_matches_pandas(spark):
    rnd = np.random.default_rng(7)
    pdf = pd.DataFrame({"county": [f"c{i}" for i in range(40)],
                        "a": np.where(rnd.random(40) < 0.3, 0.0, rnd.normal(size=40)),
                        "b": rnd.integers(0, 4, 40).astype(float)})
    long_df = reshape.unpivot(spark.createDataFrame(pdf), ["county"], ["a", "b"])
    got = {r.feature: r for r in agg.describe_nonzero(long_df).collect()}
    for f in ["a", "b"]:
        d = pdf.loc[pdf[f] != 0, f].describe()
        r = got[f]
        assert r["count"] == d["count"]
        for mine, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert abs(r[mine] - d[theirs]) < 1e-9


def test_top_k_with_tie_break(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.5), ("d", None)], "k string, s double")
    assert [r.k for r in reshape.top_k(df, "s", 2, ["k"]).collect()] == ["a", "b"]


def test_zip_unpivot_union_render(spark):
    df = spark.createDataFrame([("t", ["x", "y"], [1, 2])], "k string, a array<string>, b array<int>")
    z = reshape.zip_columns(df, ["k"], ["a", "b"]).collect()
    assert [(r.pos, r.a, r.b) for r in z] == [(0, "x", 1), (1, "y", 2)]
    w = spark.createDataFrame([("c1", 1.0, 0.0)], "county string, f1 double, f2 double")
    assert reshape.unpivot(w, ["county"], ["f1", "f2"]).count() == 2
    u = reshape.union_sources([reshape.tag(w.select("county"), "src", s) for s in ["a", "b", "c"]])
    assert u.count() == 3
    rec = w.select(reshape.render_record(F.col("county"), [("crimeRate", F.lit("42/1000"))])).first()[0]
    assert rec == "c1\n\tcrimeRate:42/1000"


def test_explode_filtered(spark):
    df = spark.createDataFrame([("denver", ["single family", "office", "condo"])], "k string, v array<string>")
    got = [r.value for r in reshape.explode_filtered(df, "v", lambda x: x.contains("o")).collect()]
    assert got == ["office", "condo"]


def test_joins_keep_all_rows_and_full_key(spark):
    left = spark.createDataFrame([("co", "jefferson"), ("oh", "jefferson"), ("oh", "adams")], "state string, county string")
    health = spark.createDataFrame([("co", "jefferson", 4.7)], "state string, county string, h double")
    out = joins.left_join_default(left, health, ["state", "county"], {"h": 0.0}).collect()
    assert sorted((r.state, r.county, r.h) for r in out) == [
        ("co", "jefferson", 4.7), ("oh", "adams", 0.0), ("oh", "jefferson", 0.0)]
    base = left.withColumn("v", F.lit(1.0))
    upd = spark.createDataFrame([("oh", "jefferson", 5.0, 1), ("oh", "jefferson", 9.0, 2)],
                                "state string, county string, v double, o int")
    got = {(r.state, r.county): r.v for r in joins.lookup_update(base, upd, ["state", "county"], ["v"], "o").collect()}
    assert got == {("co", "jefferson"): 1.0, ("oh", "jefferson"): 9.0, ("oh", "adams"): 1.0}


def test_zscore_population_std_and_constant_column(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3, 4], "a": [1.0, 2.0, 3.0, 6.0], "c": [5.0] * 4})
    out = stats.zscore(spark.createDataFrame(pdf), ["a", "c"], keep=["id"]).toPandas().sort_values("id")
    want = (pdf.a - pdf.a.mean()) / pdf.a.std(ddof=0)
    assert np.allclose(out.a, want)
    assert (out.c == 0).all()


def _np_rmse(x, y, d):
    c = np.polyfit(x, y, d)
    return float(np.sqrt(np.mean((y - np.polyval(c, x)) ** 2)))


def test_poly_fits_match_numpy(spark):
    rnd = np.random.default_rng(11)
    x = rnd.uniform(0.5, 0.95, 92)
    y = 3 + 40 * x - 25 * x ** 2 + rnd.normal(scale=0.5, size=92)
    xs = np.array([1.0, 1.0, 2.0, 2.0, 3.0])  # 3 distinct x: degrees 3, 4 not identified
    ys = np.array([1.0, 1.2, 2.0, 2.2, 2.9])
    pdf = pd.DataFrame({"g": ["a"] * 92 + ["b"] * 5, "x": np.r_[x, xs], "y": np.r_[y, ys]})
    df = spark.createDataFrame(pdf)
    fit = stats.poly_fit(df, ["g"], "x", "y")
    r = {(row.g, row.degree): row.rmse for row in stats.poly_fit_rmse(df, ["g"], "x", "y", fit=fit).collect()}
    for d in range(1, 5):
        assert abs(r[("a", d)] - _np_rmse(x, y, d)) < 1e-9
    assert abs(r[("b", 2)] - _np_rmse(xs, ys, 2)) < 1e-9
    assert r[("b", 3)] is None and r[("b", 4)] is None
    best = {row.g: row.best_degree for row in stats.poly_best_degree(fit, ["g"]).collect()}
    rm = [_np_rmse(x, y, d) for d in range(1, 5)]
    want = 1
    for d in range(2, 5):
        if rm[d - 1] < rm[want - 1]:
            want = d
    assert best["a"] == want and best["b"] == 2
    grid = stats.fit_curve_grid(df, ["g"], "x", "y", points=1000, fit=fit).filter("g = 'a'").orderBy("i").toPandas()
    xg = np.linspace(x.min(), x.max(), 1000)
    assert np.allclose(grid.x, xg) and np.allclose(grid.y, np.polyval(np.polyfit(x, y, want), xg), atol=1e-7)


def test_poly_fits_of_parts_with_other_ranges(spark):
    """NULL and far-off groups, each in many tasks whose parts have ranges of their own."""
    rnd = np.random.default_rng(3)
    parts = {None: np.sort(rnd.normal(size=4000)), "far": np.sort(1e6 + rnd.uniform(0, 1e-2, 3000)),
             "wide": np.sort(rnd.uniform(-1e8, 1e8, 3000)), "one": np.full(500, 2.5), "two": np.repeat([1.0, 4.0], 300)}
    rows, want = [], {}
    for g, x in parts.items():
        t = (x - x.mean()) / (x.std() or 1)
        y = 1e5 + 3 * t - t ** 2 + 0.2 * t ** 3 + rnd.normal(size=len(x))
        rows += [(g, float(a), float(b)) for a, b in zip(x, y)]
        want[g] = [_np_rmse(t, y, d) if len(set(x)) > d else None for d in range(1, 5)]
    rows += [("far", None, 1.0), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartitionByRange(13, "x", "y")
    fit = stats.poly_fit(df, ["g"], "x", "y")
    got = {(r.g, r.degree): r.rmse for r in stats.poly_fit_rmse(df, ["g"], "x", "y", fit=fit).collect()}
    for g, rm in want.items():
        for d, v in enumerate(rm, 1):
            assert got[g, d] is None if v is None else abs(got[g, d] - v) < 1e-7 * v, (g, d)
    best = {r.g: r.best_degree for r in stats.poly_best_degree(fit, ["g"]).collect()}
    assert best == {None: 4, "far": 4, "wide": 4, "two": 1}
    ends = {(r.g, r.i): r.x for r in stats.fit_curve_grid(df, ["g"], "x", "y", points=5, fit=fit).filter("i in (0, 4)").collect()}
    assert ends == {(g, i): parts[g][-1 if i else 0] for g in best for i in (0, 4)}
    plan = fit._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ") == 1
    assert stats.poly_fit(df.limit(0), ["g"], "x", "y").count() == 0


def test_poly_fits_of_many_groups(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS a", "IF(id % 30000 = 0, NULL, id % 30000) AS g", "id * 1.0D AS x", "id * 2.0D AS y")
    fit = stats.poly_fit(df, ["g", "a"], "x", "y", 2)
    assert fit.agg({"n": "sum"}).first()[0] == 60_000 and fit.count() == df.select("g", "a").distinct().count()


def test_linear_fit(spark):
    pdf = pd.DataFrame({"g": ["a"] * 5, "x": [1.0, 2, 3, 4, 5], "y": [2.0, 4.1, 5.9, 8.2, 9.9]})
    r = stats.linear_fit(spark.createDataFrame(pdf), ["g"], "x", "y").first()
    slope, intercept = np.polyfit(pdf.x, pdf.y, 1)
    assert abs(r.slope - slope) < 1e-9 and abs(r.intercept - intercept) < 1e-9
    assert abs(r.corr - np.corrcoef(pdf.x, pdf.y)[0, 1]) < 1e-12


def test_lloyd_step_matches_numpy(spark):
    rnd = np.random.default_rng(2)
    pts = rnd.normal(size=(200, 3))
    centres = pts[:4].tolist()
    pdf = pd.DataFrame(pts, columns=["a", "b", "c"])
    got = {r.cluster: r for r in cluster.lloyd_step(spark.createDataFrame(pdf), ["a", "b", "c"], centres).collect()}
    lab = np.argmin(((pts[:, None, :] - np.array(centres)[None]) ** 2).sum(-1), axis=1)
    for j in range(4):
        assert got[j].n == (lab == j).sum()
        assert np.allclose([got[j].a, got[j].b, got[j].c], pts[lab == j].mean(0))


def test_kmeans_elbow_and_assign(spark):
    rnd = np.random.default_rng(4)
    pts = np.vstack([rnd.normal(loc=c, scale=0.1, size=(30, 2)) for c in [(0, 0), (5, 5), (0, 5)]])
    pdf = pd.DataFrame(pts, columns=["a", "b"]).assign(id=range(90))
    df = spark.createDataFrame(pdf)
    el = {r.k: r.sse for r in cluster.kmeans_elbow(spark, df, ["a", "b"], ks=range(1, 5), restarts=3).collect()}
    assert abs(el[1] - 180.0) < 1e-6  # z-scored: n * d
    assert el[3] < el[2] < el[1] and el[3] < 1.0
    lab = cluster.kmeans_assign(df, ["id"], ["a", "b"], k=3, restarts=3).toPandas()
    assert lab.groupby(lab.id // 30).cluster.nunique().eq(1).all()


def test_quantiles_with_one_hot_value(spark):
    # a third of all rows share one value: ranks stay exact and spread out
    vals = [7.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(4)
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.9]).first()
    want = np.quantile(np.array(vals), [0.1, 0.5, 0.9])
    assert np.allclose([got.q10, got.q50, got.q90], want)
    ranked = indexed_sort(df, ["v"], index_col="i", num_partitions=6, size_col="n")
    pdf = ranked.toPandas()
    assert sorted(pdf.i) == list(range(1200)) and (pdf.n == 1200).all()


def test_quantiles_and_ranks_keep_null_groups(spark):
    rows = [(None, float(v)) for v in range(5)] + [("a", float(v)) for v in range(10, 13)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q50 for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {None: 2.0, "a": 11.0}
    ranked = indexed_sort(df, ["v"], ["g"], index_col="i").collect()
    assert sorted(r.i for r in ranked if r.g is None) == [0, 1, 2, 3, 4]
    rows2 = [(None, 1, float(v)) for v in range(4)] + [("b", None, 9.0)]
    df2 = spark.createDataFrame(rows2, "g string, h int, v double")
    got2 = {(r.g, r.h): r.q50 for r in exact_quantiles(df2, "v", [0.5], ["g", "h"]).collect()}
    assert got2 == {(None, 1): 1.5, ("b", None): 9.0}


def _np_lloyd(x, centres, tol, max_iter=300):
    c = np.array(centres, dtype=float)
    it = 0
    for _ in range(max_iter):
        lab = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        new = c.copy()
        for j in range(len(c)):
            if (lab == j).any():
                new[j] = x[lab == j].mean(0)
        shift = np.sqrt(((new - c) ** 2).sum(1)).max()
        c, it = new, it + 1
        if shift < cluster.spark_tol(tol, len(c)):
            break
    sse = ((x[:, None, :] - c[None]) ** 2).sum(-1).min(1).sum()
    return c, it, sse


def test_fits_are_fixed_points_of_numpy_lloyd(spark):
    """From a fit's centres a plain Lloyd pass moves nothing, and the costs agree."""
    rnd = np.random.default_rng(9)
    x = np.vstack([rnd.normal(loc=c, scale=0.6, size=(80, 3)) for c in [(0, 0, 0), (3, 1, 0), (0, 4, 2)]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"])).repartition(3)
    models = [(2, 1), (3, 1), (3, 2), (4, 5)]
    for init in ("random", "k-means||"):
        for (k, _), m in zip(models, cluster.fits(df, ["a", "b", "c"], models, init)):
            start = [c.tolist() for c in m.clusterCenters()]
            c, it, sse = _np_lloyd(x, start, 1e-4)
            assert len(start) == k and it == 1
            assert np.allclose(start, c, atol=cluster.spark_tol(1e-4, k))
            assert m.summary.trainingCost == pytest.approx(sse, rel=1e-3)


def test_quantile_running_sums_carry_across_arrow_batches(spark):
    rnd = np.random.default_rng(13)
    g = rnd.choice(["x", "y", None], 900)
    v = rnd.integers(0, 60, 900).astype(float)  # many repeated values
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}).astype({"g": object})).repartition(2)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.g: (r.q10, r.q50, r.q90) for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for key in ["x", "y", None]:
        vals = v[np.array([k == key for k in g])]
        assert np.allclose(got[key], np.quantile(vals, [0.1, 0.5, 0.9]))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_and_quantiles_beyond_the_sampling_size(spark, reuse):
    """Range bounds are sampled: ranks must not depend on two exchanges agreeing."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.exchange.reuse")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(2_000_000).select((F.xxhash64("id") % 1_000_003).alias("label"), F.col("id").alias("n"),
                                           (F.col("id") % 3).alias("g"), F.lit("payload").alias("p"))
        ranked = indexed_sort(df, ["label"], index_col="i")
        r = ranked.agg(F.countDistinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi")).first()
        assert (r.d, r.lo, r.hi) == (2_000_000, 0, 1_999_999)
        got = {r.g: r.m for r in exact_quantiles(df, "label", [0.5], ["g"], ["m"]).collect()}
        want = {r.g: r.m for r in df.groupBy("g").agg(F.expr("percentile(label, 0.5)").alias("m")).collect()}
        assert got == want
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_kmeans_does_not_depend_on_the_layout(spark):
    rnd = np.random.default_rng(6)
    pdf = pd.DataFrame(rnd.normal(size=(400, 3)), columns=["a", "b", "c"]).assign(id=range(400))
    df = spark.createDataFrame(pdf)
    cols = ["a", "b", "c"]
    elbow = [cluster.kmeans_elbow(spark, df.repartition(n), cols, ks=[2, 3], restarts=2).collect() for n in (1, 7)]
    assert [r.k for r in elbow[0]] == [2, 3]
    assert np.allclose([r.sse for r in elbow[0]], [r.sse for r in elbow[1]])
    labels = [{r.id: r.cluster for r in cluster.kmeans_assign(df.repartition(n), ["id"], cols, k=4, restarts=2).collect()}
              for n in (1, 7)]
    assert labels[0] == labels[1]


def test_a_fit_does_not_read_its_points_to_choose_a_solver(spark):
    """Points and their norms fill the cache, the cluster sizes are the third read; no more whatever the iterations."""
    rnd = np.random.default_rng(16)
    pdf = pd.DataFrame(rnd.normal(size=(300, 2)), columns=["a", "b"])
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame(pdf)
    models = cluster.fits(df.mapInArrow(counted, df.schema), ["a", "b"], [(2, 5), (3, 6)], "random")
    assert all(m.summary.numIter > 1 for m in models)
    assert 0 < seen.value <= 2 * 3 * len(pdf)


def test_totals_of_many_models_in_one_pass(spark):
    rnd = np.random.default_rng(12)
    pts = np.vstack([rnd.normal(size=(150, 2)), np.zeros((60, 2))])
    models = [pts[:2].tolist(), pts[5:10].tolist(), [[0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]]
    df = spark.createDataFrame(pd.DataFrame(pts, columns=["a", "b"])).repartition(5)
    got = {(r.model, r.cluster): r for r in cluster.totals(df, ["a", "b"], models).collect()}
    want = 0
    for m, c in enumerate(models):
        d = ((pts[:, None] - np.array(c)[None]) ** 2).sum(-1)
        lab = d.argmin(1)  # the first of equal centres
        for j in np.unique(lab):
            r, want = got[m, j], want + 1
            assert r.n == (lab == j).sum()
            assert np.allclose([r.a, r.b, r.sse], [*pts[lab == j].sum(0), d[lab == j, j].sum()])
    assert len(got) == want
    assert cluster.totals(df.limit(0), ["a", "b"], models).count() == 0


def test_elbow_reaches_the_known_optimum(spark):
    """Clusters far apart: the best fit has the groups' own means, the cost is the squares about them."""
    rnd = np.random.default_rng(14)
    groups = [rnd.normal(loc=c, scale=0.05, size=(40, 2)) for c in [(0, 0), (9, 0), (0, 9), (9, 9)]]
    df = spark.createDataFrame(pd.DataFrame(np.vstack(groups), columns=["a", "b"]))
    el = {r.k: r.sse for r in cluster.kmeans_elbow(spark, df, ["a", "b"], ks=[1, 4], restarts=8, scale=False).collect()}
    x = np.vstack(groups)
    assert el[1] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert el[4] == pytest.approx(sum(((g - g.mean(0)) ** 2).sum() for g in groups))


def test_describe_reads_its_input_once(spark):
    rows = [("a", float(v), i) for i, v in enumerate([3, 3, 3, 0, -1, 8, 2, 2])] + [("one", 5.0, 9), (None, 1.0, 1), (None, 4.0, 2), ("a", None, 3)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame(rows, "feature string, value double, id int")
    got = {r.feature: r for r in agg.describe_nonzero(df.mapInArrow(counted, df.schema)).collect()}
    x = np.array([3, 3, 3, -1, 8, 2, 2.0])
    assert (got["a"]["count"], got["a"]["min"], got["a"]["max"]) == (7, -1, 8)
    assert np.allclose([got["a"]["mean"], got["a"]["std"], got["a"]["p25"], got["a"]["p50"], got["a"]["p75"]],
                       [x.mean(), x.std(ddof=1), *np.quantile(x, [.25, .5, .75])])
    assert got["one"]["std"] is None and got[None]["count"] == 2 and got[None]["p50"] == 2.5
    # ranges are sampled from what the count has shuffled, the input itself is not read again
    assert seen.value == len(rows)
