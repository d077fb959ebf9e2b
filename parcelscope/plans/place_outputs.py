"""Write a place's results as the reference's result files.

For users whose downstream steps read those files: the label reports, the
``(key,n)`` and ``(key,[(label,n), ...])`` lines, the measure lines and the
multi-line quality records, one directory (or report file) per result, keys
sorted. Each result is bounded by counties x labels, so every result is
written as one file (K2); nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.functions import estimate_margin_text, render_pairs
from parcelscope.operators.aggregates import nest_histogram
from parcelscope.operators.reshape import render_record
from parcelscope.plans import place_run as R
from parcelscope.plans import places as P
from parcelscope.sources import sinks


#: Names in the written records where they differ from the features'.
QUALITY_NAMES = {"crime_rate": "crimeRate"}


def _lines(df: DataFrame, key: str, line, path: str, mode: str) -> str:
    out = df.select(F.col(key).alias("_k"), line.alias("value")).orderBy("_k").select("value")
    out.coalesce(1).write.mode(mode).text(path)
    return path


def _pair(key, value):
    return F.concat(F.lit("("), key, F.lit(","), value, F.lit(")"))


def _nested_text(arr):
    items = F.transform(arr, lambda x: F.concat(F.lit("("), x["label"], F.lit(","),
                                                 x["n"].cast("string"), F.lit(")")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def write_place_outputs(spark: SparkSession, root: str, place: P.PlaceSpec, out_dir: str,
                        mode: str = "overwrite") -> dict[str, str]:
    """Write every result of a place under ``out_dir``; returns name -> path."""
    with sinks.reused(R.label_counts(spark, root, place)) as counts:
        paths = _write_parcels(R.zoning_profile(spark, root, place, counts), place, out_dir.rstrip("/"), mode)
    return paths | _write_measures(R.census_measures(spark, root, place), out_dir.rstrip("/"), mode)


def _write_parcels(prof: dict[str, DataFrame], place: P.PlaceSpec, base: str, mode: str) -> dict[str, str]:
    title = place.name.capitalize()
    paths: dict[str, str] = {}

    def report(name, counts, heading):
        rep = sinks.count_report(counts.filter(F.col("label") != "Total"), "label", "n", heading)
        paths[name] = sinks.write_report(rep, f"{base}/{name}", mode)

    report(f"countOfAllResidentialIn{title}", prof["residential_labels"],
           f"Count of all types of Residential in {title}")
    report(f"countOfAllZonesIn{title}", prof["all_labels"], f"Count of all zones in {title}")
    per = prof["per_county"]
    paths["countOfAllResidentialByCounty"] = _lines(
        per, "county", _pair(F.col("county"), F.col("n").cast("string")),
        f"{base}/countOfAllResidentialByCounty", mode)
    nested = nest_histogram(prof["histogram"], R.KEY, "label")
    paths["countOfEachResidentialByCounty"] = _lines(
        nested, "county", _pair(F.col("county"), _nested_text(F.col("histogram"))),
        f"{base}/countOfEachResidentialByCounty", mode)
    if place.rule.kept_prefixes:
        kept = prof["histogram"].filter(
            F.substring("label", 1, 3).isin(*place.rule.kept_prefixes))
        paths["relevantResidentialByCounty"] = _lines(
            nest_histogram(kept, R.KEY, "label"), "county",
            _pair(F.col("county"), _nested_text(F.col("histogram"))),
            f"{base}/relevantResidentialByCounty", mode)
    return paths


def _write_measures(measures: list[DataFrame], base: str, mode: str) -> dict[str, str]:
    paths: dict[str, str] = {}
    names = ["meanCommuteByCounty", "commuteTypesByCounty", "percentPovertyByCounty",
             "occupancyByCounty", "allQualitiesPlusHealth", "racesByCounty", "financesByCounty"]
    for name, m in zip(names, measures):
        vals = [c for c in m.columns if c not in R.KEY]
        if name == "allQualitiesPlusHealth":
            # key, five qualities and health: seven lines a record
            m = m.withColumn("mentalHealth", F.coalesce("mentalHealth", F.lit(0.0)))
            line = render_record(F.concat(F.lit("("), F.col("county"), F.lit(",")),
                                 [(QUALITY_NAMES.get(c, c), F.col(c)) for c in vals])
            line = F.concat(line, F.lit(")"))
        elif name == "percentPovertyByCounty":
            # percent with its margin of error, to the census' one decimal
            line = _pair(F.col("county"), render_pairs([
                (f"below_poverty_{who}", estimate_margin_text(F.round(F.col(f"{who}_below_poverty") * 100, 1),
                                                              F.round(F.col(f"{who}_poverty_margin") * 100, 1)))
                for who in ("owner", "renter")]))
        else:
            line = _pair(F.col("county"), render_pairs([(c, F.col(c)) for c in vals]))
        paths[name] = _lines(m, "county", line, f"{base}/{name}", mode)
    return paths
