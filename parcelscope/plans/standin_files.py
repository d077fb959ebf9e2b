"""The driver's tables written as files in the reference's shapes.

``place_run`` reads parcels, census tables, qualities and health from files. So
that the very programs users run can be checked, customers play the parcels
(county: nation, label: market segment), and counts of customers per nation fill
the census positions. Everything is derived from the tables; only the layout,
the header blocks and the number formats are made up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.plans import places as P
from parcelscope.plans.standin_data import table
from parcelscope.session import scratch_path

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
#: Nations 0-24 are the rows of the nationwide files.
PLACE = P.PlaceSpec(
    name="standin", directory="Standin", state="ZZ", state_name="standin",
    parcels=(P.ParcelSource("parcels", 2, county_pos=0, reader="plain", header="first"),),
    rule=P.LabelRule(words=("building", "house"), single_words=("household",)),
    qol_prefix="ZZ", nationwide_rows=(0, 25))


def per_nation(spark: SparkSession, d: str) -> DataFrame:
    """(k, name, n, in_debt, one count per segment) of every nation."""
    c = table(spark, d, "customer", "c_nationkey", "c_mktsegment", "c_acctbal")
    per = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        *[F.count_if(F.col("c_mktsegment") == s).alias(s.lower()) for s in SEGMENTS])
    n = table(spark, d, "nation", "n_nationkey", "n_name")
    return (n.join(per, n.n_nationkey == per.c_nationkey, "left").drop("c_nationkey").fillna(0)
            .withColumnsRenamed({"n_nationkey": "k", "n_name": "name"}))


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.col(value).cast("string")


def _census(per: DataFrame, spec: dict[str, int], values: dict, path: str, head: int = 0) -> None:
    """One line per nation: an id, the quoted name, and values at their positions."""
    width = max(P.CENSUS_NAME_POS, *spec.values()) + 2
    cells = [F.lit("0")] * width
    cells[P.CENSUS_NAME_POS] = F.concat(F.lit('"'), "name", F.lit(' County, Standin"'))
    for key, v in values.items():
        cells[spec[key]] = F.concat(F.lit('"'), _text(v), F.lit('"'))
    _file(per.select("k", F.concat_ws(",", *cells).alias("value")), path, [f"head {i}" for i in range(head)])


def _file(lines: DataFrame, path: str, head: list[str]) -> None:
    """A single small file: its header lines, then one line per nation in order."""
    spark = lines.sparkSession
    lines = lines.select(F.col("k").cast("long").alias("k"), "value")
    if head:
        lines = lines.union(spark.createDataFrame([(i - len(head), h) for i, h in enumerate(head)], "k long, value string"))
    lines.coalesce(1).sortWithinPartitions("k").select("value").write.text(path)


def write_place(spark: SparkSession, d: str) -> str:
    """Write all files of ``PLACE`` to scratch; returns their root."""
    root = scratch_path(spark, "standin-place")
    base, per = f"{root}/{PLACE.directory}", per_nation(spark, d)
    n = F.col("n")
    c, na = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment"), table(spark, d, "nation", "n_nationkey", "n_name")
    parcels = (c.join(na, c.c_nationkey == na.n_nationkey)
               .select(F.col("c_custkey").alias("k"), F.concat_ws(",", "n_name", "c_custkey", "c_mktsegment").alias("value")))
    head = spark.createDataFrame([(-1, "county,id,label")], "k long, value string")
    (parcels.union(head).repartitionByRange("k").sortWithinPartitions("k").select("value").write.text(f"{base}/parcels"))
    _census(per, P.TRANSPORT_MEANS, {"commute_time_in_mins": n % 60}, f"{base}/transportation_means.csv", P.CENSUS_SKIP)
    _census(per, P.TRANSPORT_TYPE, {"total": n, **dict(zip(("car", "public", "bicycle", "walk", "wfh"),
                                                           (s.lower() for s in SEGMENTS)))},
            f"{base}/transportation_type.csv", P.CENSUS_SKIP)
    _census(per, P.POVERTY, {"owner_pct": n % 30, "owner_moe": n % 4, "renter_pct": n % 50, "renter_moe": n % 5},
            f"{base}/poverty.csv", P.CENSUS_SKIP)
    _census(per, P.OCCUPANCY, {"total": n, "occupied": n - F.col("in_debt"), "vacant": "in_debt"},
            f"{base}/occupancy.csv", P.CENSUS_SKIP)
    _file(per.select("k", F.concat(F.lit('"'), "name", F.lit('",'), _text(n % 9), F.lit(".5")).alias("value")),
          f"{base}/mental_health.csv", ["county,days", "unit,x"])
    _census(per, P.RACE, {k: n % (20 + i) for i, k in enumerate(P.RACE)}, f"{root}/housing_race.csv")
    _census(per, P.FINANCIAL, {"median_income": n * 100}, f"{root}/housing_financial.csv")
    cells = [F.lit("")] * (max(P.QOL.values()) + 1)
    cells[0] = F.concat(F.lit("ZZ"), "name", F.lit(" County"))
    cells[P.QOL["crime"]] = F.concat(_text(n % 40), F.lit("/1000"))
    cells[P.QOL["unemployment"]] = F.concat(_text(n % 8), F.lit(".25%"))
    cells[P.QOL["national_parks"]] = _text(n % 3)
    cells[P.QOL["state_park_coverage"]] = F.concat(_text(n % 6), F.lit(".5%"))
    cells[P.QOL["cost_of_living"]] = F.concat(F.lit('"$'), F.format_number(n * 10, 2), F.lit('"'))
    _file(per.select("k", F.concat_ws(",", *cells).alias("value")), f"{root}/QOL.csv",
          [",".join(f"h{i}" for i in range(len(cells)))])
    return root


#: Shared part of the SQL twins: one row per nation.
PER_SQL = """per AS (
  SELECT lower(n_name) AS county, count(c_custkey) AS n, count(*) FILTER (c_acctbal < 0) AS in_debt,
    """ + ", ".join(f"count(*) FILTER (c_mktsegment = '{s}') AS {s.lower()}" for s in SEGMENTS) + """
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name)"""
