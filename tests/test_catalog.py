"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale factor; the k-means fits without an oracle are checked
for shape."""

import duckdb
import pytest

import __spark_entry__ as E
from parcelscope.plans.catalog import QUERIES
from parcelscope.plans.oracles import ORACLES
from tools.check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"kmeans_elbow", "kmeans_assign"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE
    assert set(ORACLES) <= set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_kmeans_queries_shape(spark):
    el = QUERIES["kmeans_elbow"](spark, SF).collect()
    assert [r.k for r in el] == list(range(1, 11))
    assert all(r.sse >= 0 for r in el) and el[-1].sse < el[0].sse
    lab = QUERIES["kmeans_assign"](spark, SF)
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert lab.count() == n and {r.cluster for r in lab.select("cluster").distinct().collect()} <= set(range(6))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["feature", "n", "slope", "intercept", "corr", "r2"]
    assert df.count() >= 0
