"""The analysis of a feature table (the reference's notebook, on Spark).

Works on any table with key columns and numeric feature columns, e.g.
:func:`parcelscope.plans.place_run.feature_table` (the reference's 23
features) or :func:`parcelscope.plans.features.county_features`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelscope.operators import aggregates as agg
from parcelscope.operators import cluster, reshape, stats
from parcelscope.operators import filters as flt
from parcelscope.session import ensure_checkpoint_dir


def analyze(spark: SparkSession, table: DataFrame, key: list[str], features: list[str],
            share: str = "percent_residential", multi_share: str = "percent_multi",
            total: str = "all_residential", min_total: float = 1, min_share: float = 0.70,
            k: int = 6, ks=range(1, 11), restarts: int = 10,
            fit_to_rows: bool = False, centres: list[list[float]] | None = None) -> dict[str, DataFrame]:
    """Summary, top-5 tables, clusters and fits of ``table``.

    * ``centres`` (of the scaled features) are taken instead of fitted ones, so that
      the whole run can be checked: ``k`` is their number;
    * more clusters than rows are an error; with ``fit_to_rows`` the elbow leaves
      them out, and ``k`` is lowered to the number of rows;
    * rows with ``total`` <= ``min_total`` are dropped first (F5);
    * ``summary``: describe over non-zero values (A10);
    * ``top_single`` / ``top_multi``: five largest shares (R6);
    * ``scaled``: z-scores (M1); ``elbow``: SSE per k (M2); ``clusters`` (M3);
    * ``pairs``: share vs each feature, zeros dropped, rows with share above
      ``min_share`` (M7); ``linear``: line per feature (M4); ``rmse`` and
      ``best``: polynomial degrees 1-4 (M5); ``curves``: the best fit on a
      1000-point grid (M6).
    """
    # Every result below is its own action. The table has one row per county,
    # so it is written once to the shared checkpoint directory (an eager
    # checkpoint): the analyses read it instead of recomputing it from the
    # parcel and census inputs ten times, and its lineage is cut.
    ensure_checkpoint_dir(spark)
    t = table.filter(flt.threshold(total, ">", min_total)).checkpoint(eager=True)
    n_rows = t.count()
    k = k if centres is None else len(centres)
    if fit_to_rows:
        ks, k = [x for x in ks if x <= n_rows], min(k, n_rows)
    if max([k, *ks]) > n_rows:
        raise ValueError(f"{n_rows} rows have {total} > {min_total}: too few for {max([k, *ks])} clusters")
    out: dict[str, DataFrame] = {}
    long_df = reshape.unpivot(t, key, features)
    out["summary"] = agg.describe_nonzero(long_df)
    out["top_single"] = reshape.top_k(t, share, 5, key)
    out["top_multi"] = reshape.top_k(t, multi_share, 5, key)
    out["scaled"] = stats.zscore(t, features, keep=key)
    if ks:
        out["elbow"] = cluster.kmeans_elbow(spark, t, features, ks=ks, restarts=restarts)
    out["clusters"] = (cluster.kmeans_assign(t, key, features, k=k, restarts=restarts) if centres is None
                       else out["scaled"].select(*key, cluster.nearest_centre(features, centres).cast("int").alias("cluster")))
    others = [f for f in features if f != share]
    pairs = stats.share_vs_feature(t, key, share, others, min_share=min_share)
    out["pairs"] = pairs.join(out["clusters"], key, "left")
    out["linear"] = stats.linear_fit(pairs, ["feature"], share, "value")
    fit = stats.poly_fit(pairs, ["feature"], share, "value")
    out["rmse"] = stats.poly_fit_rmse(pairs, ["feature"], share, "value", fit=fit)
    out["best"] = stats.poly_best_degree(fit, ["feature"])
    out["curves"] = stats.fit_curve_grid(pairs, ["feature"], share, "value", fit=fit)
    return out

