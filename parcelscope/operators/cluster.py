"""k-means (M2, M3) on Spark ML.

The elbow fits k = 1..10 with 10 random restarts each, the assignment k = 6 with
10 restarts; each fit is Spark ML's ``KMeans``. What this module adds:

* the scaled points are written once, dealt and sorted by their own values (or
  ids), so all fits read a small, narrow table, the draws of a seed don't depend
  on how the input was partitioned, and a lost executor costs no recomputation
  of the input. Adaptive execution sizes its files, so a small table is one task
  a pass;
* fits run side by side, as each is a chain of small jobs;
* k = 1 has one solution, whose cost is an aggregate;
* scikit-learn's tolerance is translated per centre (:func:`spark_tol`).

Labels and costs for given centres (:func:`totals`, :func:`nearest_centre`) are
column expressions: the k x d numbers are literals, points join nothing.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.operators.stats import zscore, zscore_params
from parcelscope.session import materialise

#: Fits that run side by side; each caches its own copy of the points.
SIDE_BY_SIDE = 8


def spark_tol(tol: float, k: int, mean_var: float = 1.0) -> float:
    """Convert a scikit-learn style tolerance (total squared centre shift
    <= tol * mean feature variance) into a per-centre one (every centre moves
    less than eps): eps = sqrt(tol * mean_var / k) stops no earlier than the
    scikit-learn rule would."""
    return math.sqrt(tol * mean_var / max(k, 1))


def _sqdist(features: list[str], centre: list[float]) -> Column:
    d = F.lit(0.0)
    for f, v in zip(features, centre):
        diff = F.col(f) - F.lit(float(v))
        d = d + diff * diff
    return d


def _nearest(features: list[str], centres: list[list[float]]) -> Column:
    """struct(d, j): squared distance to, and index of, the nearest centre
    (lowest index on ties)."""
    dists = [F.struct(_sqdist(features, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centres)]
    return dists[0] if len(dists) == 1 else F.least(*dists)


def nearest_centre(features: list[str], centres: list[list[float]]) -> Column:
    """Index of the nearest centre (squared Euclidean), lowest index on ties."""
    return _nearest(features, centres)["j"]


def totals(points: DataFrame, features: list[str], models: list[list[list[float]]]) -> DataFrame:
    """Per model and cluster: count, coordinate sums and squared distances of the
    points nearest to each of its given centres.

    One pass for all models; partial sums leave a task, never points. Clusters
    without points have no row.
    """
    x = points.select(*[F.col(f).cast("double").alias(f) for f in features])
    near = F.array(*[F.struct(F.lit(m).alias("model"), _nearest(features, c).alias("near"))
                     for m, c in enumerate(models)])
    x = x.select(*features, F.explode(near).alias("_m"))
    return (x.groupBy(F.col("_m.model").alias("model"), F.col("_m.near.j").alias("cluster"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in features], F.sum("_m.near.d").alias("sse")))


def lloyd_step(df: DataFrame, features: list[str], centres: list[list[float]]) -> DataFrame:
    """The clusters of given centres: (cluster, n, <feature means>, sse)."""
    return totals(df, features, [centres]).select("cluster", "n", *[(F.col(f) / F.col("n")).alias(f) for f in features], "sse")


def _scaled(df: DataFrame, features: list[str], keep: list[str], params) -> DataFrame:
    if params is not None:
        return zscore(df, features, keep=keep, params=params)
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])


def _points(df: DataFrame, features: list[str], keep: list[str], params) -> DataFrame:
    """The scaled points, written once in an order of their own."""
    by = keep or features
    return materialise(_scaled(df, features, keep, params).repartition(*by).sortWithinPartitions(*by), "points")


def fits(points: DataFrame, features: list[str], models: list[tuple[int, int]], init: str,
         max_iter: int = 300, tol: float = 1e-4) -> list[KMeansModel]:
    """Spark ML's model for every (k, seed), side by side.

    ``solver="row"`` is what Spark ML settles on by itself for vectors of no more
    components than there are points, but only after reading them all to find out.
    """
    vectors = points.select(array_to_vector(F.array(*features)).alias("features"))

    def fit(model: tuple[int, int]) -> KMeansModel:
        k, seed = model
        return KMeans(k=k, seed=seed, maxIter=max_iter, tol=spark_tol(tol, k), initMode=init, solver="row").fit(vectors)
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(inheritable_thread_target(points.sparkSession)(fit), models))


def sse_of_mean(df: DataFrame, features: list[str]) -> DataFrame:
    """One row ``sse``: the squared deviations from the mean, sum_f n * var_pop(f)."""
    parts = [F.count(f) * F.coalesce(F.var_pop(F.col(f).cast("double")), F.lit(0.0)) for f in features]
    return df.agg(sum(parts[1:], parts[0]).alias("sse"))


def kmeans_elbow(spark: SparkSession, df: DataFrame, features: list[str],
                 ks=range(1, 11), restarts: int = 10, seed: int = 1,
                 max_iter: int = 300, tol: float = 1e-4, scale: bool = True) -> DataFrame:
    """M2: within-cluster SSE of the best of ``restarts`` random starts, per k.

    ``tol`` follows scikit-learn (see :func:`spark_tol`); the data are
    z-scored first, so the mean feature variance is 1. Ties between points are
    drawn as they are: a start with fewer than k different points has fewer centres.
    """
    ks = list(ks)
    points = _points(df, features, [], zscore_params(df, features) if scale else None)
    models = [(k, seed + k * restarts + r) for k in ks if k >= 2 for r in range(restarts)]
    best: dict[int, float] = {}
    for (k, _), model in zip(models, fits(points, features, models, "random", max_iter, tol)):
        best[k] = min(float(model.summary.trainingCost), best.get(k, math.inf))
    if 1 in ks:
        best[1] = float(sse_of_mean(points, features).first()["sse"])
    return spark.createDataFrame(sorted(best.items()), "k int, sse double")


def kmeans_assign(df: DataFrame, id_cols: list[str], features: list[str], k: int = 6,
                  restarts: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4,
                  scale: bool = True) -> DataFrame:
    """M3: cluster label per row from the best of ``restarts`` fits, each started by
    k-means|| (scikit-learn's default start is k-means++, its sequential form)."""
    params = zscore_params(df, features) if scale else None
    points = _points(df, features, id_cols, params)
    done = fits(points, features, [(k, seed + r) for r in range(restarts)], "k-means||", max_iter, tol)
    best = min(done, key=lambda m: m.summary.trainingCost)
    centres = [c.tolist() for c in best.clusterCenters()]
    return points.select(*id_cols, nearest_centre(features, centres).cast("int").alias("cluster"))
