"""Run a place end to end from its files (E1-E8), and build the feature
table of several places (J3) for the analysis (E9).

Every step is a DataFrame; results are keyed by (state, county). Nothing is
collected on the driver except one header row per parcel file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope import functions as fn
from parcelscope.operators import aggregates as agg
from parcelscope.operators import filters as flt
from parcelscope.operators.joins import assemble
from parcelscope.operators.reshape import union_sources
from parcelscope.plans import places as P
from parcelscope.session import materialise
from parcelscope.sources import files

KEY = ["state", "county"]


# ----------------------------------------------------------------- parcels

def _label_source(spark: SparkSession, path: str, src: P.ParcelSource) -> DataFrame:
    """(county, label) rows of one parcel file, lower-cased labels, NULL -> 'null'."""
    need = max(src.label_pos, src.county_pos or 0) + 1
    n_cols = src.n_cols or need
    if src.reader == "csv":
        if src.header == "first":
            # the first row is read from the first file's beginning, the rows by many tasks
            head = files.first_row(files.read_csv_multiline(spark, path, n_cols))
            raw = files.drop_header_row(files.read_csv_records(spark, path, n_cols), head)
        else:
            raw = files.read_csv_records(spark, path, n_cols, skip=src.skip)
        label = F.col(f"_c{src.label_pos}")
        county = F.col(f"_c{src.county_pos}") if src.county_pos is not None else None
        rows = raw.select(county.alias("county") if county is not None else F.lit(None).alias("county"),
                          label.alias("label"))
    else:
        lines = files.read_lines(spark, path)
        if src.header == "first":
            lines = files.drop_header_row(lines)
        else:
            lines = files.skip_first_rows(lines, src.skip)
        if src.reader == "quoted":
            arr = fn.split_quoted("value", keep_trailing_empty=False)
            get = lambda k: F.get(arr, k)
        else:
            get = lambda k: fn.split_pick("value", k)
        rows = lines.select(
            (get(src.county_pos) if src.county_pos is not None else F.lit(None)).alias("county"),
            get(src.label_pos).alias("label"))
    if src.county is not None:
        rows = rows.withColumn("county", F.lit(src.county))
    return rows.select(F.lower(fn.strip_quotes("county")).alias("county"),
                       fn.lower_label(fn.null_label("label")).alias("label"))


def load_parcels(spark: SparkSession, root: str, place: P.PlaceSpec) -> DataFrame:
    """Parcels of a place: (state, county, label); several sources are unioned (R2)."""
    paths = P.dataset_paths(root, place)
    frames = [_label_source(spark, paths[f"parcels:{s.dataset}"], s) for s in place.parcels]
    return union_sources(frames).select(F.lit(place.state_name).alias("state"), "county", "label")


def residential(parcels: DataFrame, rule: P.LabelRule) -> DataFrame:
    """F1 / F2: the residential parcels by the place's label rule."""
    if rule.prefix is not None:
        return parcels.filter(flt.prefix("label", rule.prefix))
    return parcels.filter(flt.keyword_any("label", [w.lower() for w in rule.words]))


def _is_single(rule: P.LabelRule) -> Column:
    conds = []
    if rule.single_words:
        conds.append(flt.keyword_any("label", [w.lower() for w in rule.single_words]))
    if rule.single_prefixes:
        conds.append(flt.prefix_any("label", list(rule.single_prefixes)))
    out = reduce(lambda a, b: a | b, conds) if conds else F.lit(False)
    for county, label in rule.single_exact:
        out = F.when(F.col("county") == county, F.col("label") == label).otherwise(out)
    for county, word in rule.single_without:
        out = out & ~((F.col("county") == county) & flt.keyword_any("label", [word]))
    return out


def label_counts(spark: SparkSession, root: str, place: P.PlaceSpec) -> DataFrame:
    """Parcels of a place by (state, county, label): the one pass over them that
    every parcel result is made of."""
    return agg.histogram_per_key(load_parcels(spark, root, place), KEY, "label")


def zoning_profile(spark: SparkSession, root: str, place: P.PlaceSpec, counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The label reports and per-county counts of a place.

    ``counts`` are its :func:`label_counts`, for instance kept by ``sinks.reused``
    while several results are written; by default each result reads the parcels.

    * ``all_labels``: count per label with a ``Total`` row (all parcels);
    * ``residential_labels``: the same over residential parcels;
    * ``per_county``: residential parcels per county (A4);
    * ``histogram``: (county, label, n) over residential parcels (A5);
    * ``kept``: the histogram restricted to the kept codes (A6) with each
      county's total (A7), counties without any kept code included.
    """
    counts = label_counts(spark, root, place) if counts is None else counts
    hist = residential(counts, place.rule)

    def report(of: DataFrame) -> DataFrame:
        return agg.with_total_row(agg.count_by_value(of, "label", weight="n"), "label")
    out = {
        "all_labels": report(counts),
        "residential_labels": report(hist),
        "per_county": hist.groupBy(*KEY).agg(F.sum("n").cast("long").alias("n")),
        "histogram": hist,
    }
    if place.rule.kept_prefixes:
        kept = hist.filter(flt.prefix_any("label", list(place.rule.kept_prefixes)))
        totals = kept.groupBy(*KEY).agg(F.sum("n").cast("long").alias("kept_total"))
        out["kept"] = hist.select(*KEY).distinct().join(totals, KEY, "left") \
            .fillna(0, subset=["kept_total"])
    return out


def housing_mix(spark: SparkSession, root: str, place: P.PlaceSpec, counts: DataFrame | None = None) -> DataFrame:
    """P24 per county: all residential (kept codes when the rule has them),
    single family, the rest, and both shares, from the place's :func:`label_counts`."""
    res = residential(label_counts(spark, root, place) if counts is None else counts, place.rule)
    if place.rule.kept_prefixes:
        res = res.filter(flt.prefix_any("label", list(place.rule.kept_prefixes)))
    single = _is_single(place.rule)
    a = res.groupBy(*KEY).agg(F.sum("n").cast("long").alias("all_residential"),
                              F.sum(F.when(single, F.col("n")).otherwise(0)).cast("long").alias("sf_residential"))
    mix = fn.housing_mix("all_residential", "sf_residential")
    return a.select(*KEY, "all_residential", "sf_residential",
                    mix["multi"].alias("multi_residential"),
                    mix["single_share"].alias("percent_residential"),
                    mix["multi_share"].alias("percent_multi"))


# ------------------------------------------------------------------ census

def county_of(name: Column) -> Column:
    """``"Adams County, Ohio"`` -> ``adams`` (state part and suffix removed)."""
    first = F.split_part(name, F.lit(","), F.lit(1))
    return F.trim(F.replace(F.lower(fn.strip_quotes(first)), F.lit(" county"), F.lit("")))


#: Files of all places, and the columns read from them.
NATIONWIDE = {"housing_race": P.RACE, "housing_financial": P.FINANCIAL}


def nationwide(spark: SparkSession, root: str, places: list[P.PlaceSpec]) -> dict[str, DataFrame]:
    """The rows of the nationwide census files that belong to any of the places, with
    their ``row`` in the file, and the quality rows of their states: each file is
    scanned once, whatever the number of places, and its few rows are written."""
    out = {}
    for name, cols in NATIONWIDE.items():
        spans = [p.nationwide_rows for p in places]
        lo, hi = min(s[0] for s in spans), max(s[1] for s in spans)
        part = read_census(spark, P.dataset_paths(root, places[0])[name], cols, rows=(lo, hi), row_col="row")
        mine = reduce(lambda a, b: a | b, [(F.col("row") >= a) & (F.col("row") < b) for a, b in spans])
        out[name] = materialise(part.filter(mine), name)
    lines = files.drop_header_row(files.read_lines(spark, P.dataset_paths(root, places[0])["QOL"]))
    out["QOL"] = materialise(lines.filter(flt.prefix_any("value", sorted({p.qol_prefix for p in places}))), "QOL")
    return out


def read_census(spark: SparkSession, path: str, positions: dict[str, int], skip: int = P.CENSUS_SKIP,
                rows: tuple[int, int] | None = None, row_col: str | None = None) -> DataFrame:
    """A census table: skip its leading rows (S4) or keep a row range (S5),
    parse the line as CSV (quoted names stay one field) and keep the
    (name, <positions>) columns, all as text. Only the needed columns are
    parsed (CSV column pruning)."""
    n = max([P.CENSUS_NAME_POS, *positions.values()]) + 1
    raw = (spark.read.schema(files.string_schema(n)).option("header", False)
           .option("quote", '"').option("escape", '"').csv(path))
    if rows is not None:
        raw = files.row_range_slice(raw, rows[0], rows[1], per_file=True, index_col=row_col)
    else:
        raw = files.skip_first_rows(raw, skip, per_file=True)
    return raw.select(*([row_col] if row_col else []), F.col(f"_c{P.CENSUS_NAME_POS}").alias("name"),
                      *[F.col(f"_c{p}").alias(k) for k, p in positions.items()])


def _keyed(df: DataFrame, place: P.PlaceSpec, name_col: Column) -> DataFrame:
    county = F.lit(place.area) if place.single_area else name_col
    out = df.withColumn("state", F.lit(place.state_name)).withColumn("county", county)
    if place.counties:
        out = out.filter(flt.key_in_set("county", place.counties))
    return out


def census_measures(spark: SparkSession, root: str, place: P.PlaceSpec,
                    shared: dict[str, DataFrame] | None = None) -> list[DataFrame]:
    """Per-county measures of a place, typed (missing -> NULL); ``shared`` are
    the :func:`nationwide` rows of several places.

    Besides the features: the number of commuters, the bicycle share and the
    margins of error of the poverty rates.
    """
    paths = P.dataset_paths(root, place)
    parts = []
    tm = read_census(spark, paths["transportation_means"], P.TRANSPORT_MEANS)
    parts.append(_keyed(tm, place, county_of(F.col("name"))).select(
        *KEY, fn.parse_double(fn.null_if_missing("commute_time_in_mins")).alias("commute_time_in_mins")))
    tt = read_census(spark, paths["transportation_type"], P.TRANSPORT_TYPE)
    modes = [m for m in P.TRANSPORT_TYPE if m != "total"]
    total = fn.parse_double(fn.null_if_missing("total"))
    shares = fn.mode_shares(total, {m: fn.parse_double(fn.null_if_missing(m)) for m in modes})
    parts.append(_keyed(tt, place, county_of(F.col("name"))).select(
        *KEY, total.alias("commuters"), *[shares[m].alias(f"percentage_{m}") for m in modes]))
    pov = read_census(spark, paths["poverty"], P.POVERTY)
    # percent -> fraction, so every place has one unit
    parts.append(_keyed(pov, place, county_of(F.col("name"))).select(
        *KEY, (fn.parse_double("owner_pct") / 100).alias("owner_below_poverty"),
        (fn.parse_double("renter_pct") / 100).alias("renter_below_poverty"),
        (fn.parse_double("owner_moe") / 100).alias("owner_poverty_margin"),
        (fn.parse_double("renter_moe") / 100).alias("renter_poverty_margin")))
    occ = read_census(spark, paths["occupancy"], P.OCCUPANCY)
    parts.append(_keyed(occ, place, county_of(F.col("name"))).select(
        *KEY, fn.ratio(fn.parse_long("occupied"), fn.parse_long("total")).alias("percentage_occupancy"),
        fn.ratio(fn.parse_long("vacant"), fn.parse_long("total")).alias("percentage_vacant")))
    lo, hi = place.nationwide_rows

    def of_place(name: str) -> DataFrame:
        if shared is None:
            return read_census(spark, paths[name], NATIONWIDE[name], rows=(lo, hi))
        return shared[name].filter((F.col("row") >= lo) & (F.col("row") < hi)).drop("row")
    parts.append(quality_of_life(spark, root, place, shared and shared["QOL"]))
    race = of_place("housing_race")
    parts.append(_keyed(race, place, county_of(F.col("name"))).select(
        *KEY, *[fn.parse_double(fn.null_if_missing(c)).alias(c) for c in P.RACE]))
    fin = of_place("housing_financial")
    parts.append(_keyed(fin, place, county_of(F.col("name"))).select(
        *KEY, fn.parse_double(fn.null_if_missing("median_income")).alias("median_income")))
    return parts


def quality_of_life(spark: SparkSession, root: str, place: P.PlaceSpec, lines: DataFrame | None = None) -> DataFrame:
    """Five qualities from QOL.csv left-joined with mental health (J1), which
    is NULL for a place that has none."""
    paths = P.dataset_paths(root, place)
    n = max(P.QOL.values()) + 1
    lines = files.drop_header_row(files.read_lines(spark, paths["QOL"])) if lines is None else lines
    q = lines.filter(flt.prefix("value", place.qol_prefix)).select(fn.csv_fields("value", n).alias("r"))
    state, county = fn.clean_key(F.col("r._c0"))
    q = q.select(county.alias("qol_county"),
                 fn.ratio_text(F.col(f"r._c{P.QOL['crime']}")).alias("crime_rate"),
                 fn.percent_text(F.col(f"r._c{P.QOL['unemployment']}")).alias("unemployment"),
                 fn.parse_long(F.col(f"r._c{P.QOL['national_parks']}")).alias("nationalParkCount"),
                 fn.percent_text(F.col(f"r._c{P.QOL['state_park_coverage']}")).alias("stateParkCoverage"),
                 fn.currency_text(F.col(f"r._c{P.QOL['cost_of_living']}")).alias("costOfLiving"))
    q = _keyed(q, place, F.col("qol_county")).drop("qol_county")
    if not place.has_health:
        return q.withColumn("mentalHealth", F.lit(None).cast("double"))
    h = files.skip_first_rows(files.read_lines(spark, paths["mental_health"]), P.HEALTH_SKIP)
    h = h.select(F.lower(fn.strip_quotes(fn.split_pick("value", 0))).alias("h_county"),
                 fn.parse_double(fn.split_pick("value", 1)).alias("mentalHealth"))
    if place.health_prefix:
        h = h.filter(flt.prefix("h_county", place.health_prefix.lower()))
    h = _keyed(h, place, county_of(F.col("h_county"))).drop("h_county")
    h = h.groupBy(*KEY).agg(F.max("mentalHealth").alias("mentalHealth"))
    return q.join(h, KEY, "left")


def place_features(spark: SparkSession, root: str, place: P.PlaceSpec,
                   zero_fill: bool = True, shared: dict[str, DataFrame] | None = None) -> DataFrame:
    """J3 for one place: one row per county (or city), the reference's 23
    features, plus ``level``: the geography of the parcel data (the census
    and quality values of a city come from its county's rows)."""
    # one row per county, used as spine and as part: written once
    mix = materialise(housing_mix(spark, root, place), "housing-mix")
    measures = census_measures(spark, root, place, shared)
    spine = mix.select(*KEY)
    out = assemble(spine, [mix, *[m.dropDuplicates(KEY) for m in measures]], KEY,
                   P.FEATURE_COLUMNS, zero_fill=zero_fill)
    return out.select(*KEY, F.lit(place.level).alias("level"), *P.FEATURE_COLUMNS)


def feature_table(spark: SparkSession, root: str, names: list[str] | None = None,
                  zero_fill: bool = True) -> DataFrame:
    """The feature table of several places (all six by default)."""
    names = names or list(P.PLACES)
    places = [P.PLACES[n] for n in names]
    shared = nationwide(spark, root, places)
    return union_sources([place_features(spark, root, p, zero_fill, shared) for p in places])
