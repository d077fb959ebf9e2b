"""The reference's six places as configuration.

A place is data, not a program: where its parcel files are, how the land-use
label is read, which labels count as residential / single family, and which
rows of the shared files belong to it. One loader and one set of operators
serve all places (see :mod:`parcelscope.plans.place_run`).

Layout under a root directory (the reference's ``zoning/``)::

    <root>/<Place>/<parcel files>
    <root>/<Place>/{transportation_means,transportation_type,poverty,occupancy,mental_health}.csv
    <root>/QOL.csv  <root>/housing_race.csv  <root>/housing_financial.csv

Census positions are *true* CSV positions. The reference split census lines
on every comma, so the quoted ``"X County, State"`` name took two fields and
each of its positions >= 2 is one more than the true position given here.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ParcelSource:
    dataset: str                 # file (or directory) name under <root>/<Place>/
    label_pos: int               # position of the land-use label
    county: str | None = None    # constant county tag; None: read from county_pos
    county_pos: int | None = None
    reader: str = "csv"          # csv: multi-line CSV | quoted: lines, quote-aware split | plain: lines, comma split
    header: str = "first"        # first: drop rows equal to the first row | skip: skip `skip` rows per file
    skip: int = 1
    n_cols: int | None = None    # columns to parse (default label/county position + 1)


@dataclass(frozen=True)
class LabelRule:
    words: tuple[str, ...] = ()          # residential: label holds any word (substring)
    prefix: str | None = None            # residential: label starts with this code
    kept_prefixes: tuple[str, ...] = ()  # the codes counted as "all residential"
    single_words: tuple[str, ...] = ()   # single family: label holds any word
    single_prefixes: tuple[str, ...] = ()
    # counties counted otherwise: the exact single-family label, or a word that excludes a label
    single_exact: tuple[tuple[str, str], ...] = ()
    single_without: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class PlaceSpec:
    name: str
    directory: str
    state: str                            # two-letter code as used in QOL keys
    state_name: str
    parcels: tuple[ParcelSource, ...]
    rule: LabelRule
    qol_prefix: str                       # QOL rows of this place start with it
    health_prefix: str | None = None      # mental-health rows kept (None: all)
    has_health: bool = True               # False: the place joins no mental health
    counties: tuple[str, ...] = ()        # keep only these counties (empty: all)
    nationwide_rows: tuple[int, int] = (0, 0)  # [lo, hi) rows of housing_race/financial
    single_area: bool = False             # one area: every census row belongs to it
    area: str | None = None               # key of the single area
    level: str = "county"                 # geography of the parcel data: county | city


# Census column positions (true CSV positions).
CENSUS_NAME_POS = 1
TRANSPORT_MEANS = {"commute_time_in_mins": 786}
TRANSPORT_TYPE = {"total": 2, "car": 4, "public": 16, "bicycle": 28, "walk": 30, "wfh": 34}
POVERTY = {"owner_pct": 182, "owner_moe": 183, "renter_pct": 184, "renter_moe": 185}
OCCUPANCY = {"total": 2, "occupied": 3, "vacant": 4}
RACE = {"white_percent": 58, "black_percent": 60, "asian_percent": 64, "latino_percent": 72}
FINANCIAL = {"median_income": 26}
CENSUS_SKIP = 3
HEALTH_SKIP = 2
# QOL.csv positions (read with a quote-aware parse, so already true).
QOL = {"crime": 8, "unemployment": 9, "national_parks": 16, "state_park_coverage": 17,
       "cost_of_living": 18}

# The reference's label word lists and code prefixes.
COLORADO_WORDS = ("family", "home", "condo", "duplex", "house", "apt", "apartment", "triplex")
DETROIT_WORDS = ("family", "apt", "condo", "duplex", "house")
PLACER_WORDS = ("single", "home", "apartment")
DALLAS_WORDS = ("residence", "home", "condo", "duplex", "house")
HOUSTON_WORDS = ("residential",)
OHIO_RESIDENTIAL_PREFIX = "5"
OHIO_KEPT_CODES = ("510", "520", "530", "540", "550", "560")

PLACES: dict[str, PlaceSpec] = {
    "colorado": PlaceSpec(
        name="colorado", directory="Colorado", state="CO", state_name="colorado",
        parcels=(
            ParcelSource("denver-parcels.csv", 51, county="denver", reader="quoted", header="skip"),
            ParcelSource("jefferson-parcels.csv", 0, county="jefferson", reader="quoted", header="skip"),
            ParcelSource("weld-parcels.csv", 33, county="weld", reader="quoted", header="skip"),
        ),
        rule=LabelRule(words=COLORADO_WORDS, single_words=("single family",),
                       single_exact=(("denver", "single family"),),
                       single_without=(("weld", "secondary"),)),
        qol_prefix="CO", counties=("denver", "jefferson", "weld"), nationwide_rows=(4, 7)),
    "ohio": PlaceSpec(
        name="ohio", directory="Ohio", state="OH", state_name="ohio",
        parcels=(ParcelSource("ohio-parcels.csv", 3, county_pos=0, reader="plain", header="first"),),
        rule=LabelRule(prefix=OHIO_RESIDENTIAL_PREFIX, kept_prefixes=OHIO_KEPT_CODES,
                       single_prefixes=("510",)),
        qol_prefix="OH", nationwide_rows=(8, 46)),
    "detroit": PlaceSpec(
        name="detroit", directory="Detroit", state="MI", state_name="michigan",
        parcels=(ParcelSource("detroit-parcels.csv", 14, county="detroit"),),
        rule=LabelRule(words=DETROIT_WORDS, single_words=("single family",)),
        qol_prefix="MIWayne ", has_health=False, nationwide_rows=(7, 8), single_area=True, area="detroit",
        level="city"),
    "placer": PlaceSpec(
        name="placer", directory="Placer", state="CA", state_name="california",
        parcels=(ParcelSource("placer-parcels.csv", 33, county="placer"),),
        rule=LabelRule(words=PLACER_WORDS, single_words=("half plex",)),
        qol_prefix="CAPlacer ", health_prefix="placer", nationwide_rows=(3, 4),
        single_area=True, area="placer"),
    "dallas": PlaceSpec(
        name="dallas", directory="Dallas", state="TX", state_name="texas",
        parcels=(ParcelSource("dallas-parcels.csv", 14, county="dallas"),),
        rule=LabelRule(words=DALLAS_WORDS, single_words=("single family",)),
        qol_prefix="TXDallas ", health_prefix="dallas", nationwide_rows=(46, 47),
        single_area=True, area="dallas"),
    "houston": PlaceSpec(
        name="houston", directory="Houston", state="TX", state_name="texas",
        parcels=(ParcelSource("houston-parcels.csv", 34, county="houston"),),
        rule=LabelRule(words=HOUSTON_WORDS, single_words=("single-family",)),
        qol_prefix="TXHarris ", health_prefix="harris", nationwide_rows=(47, 48),
        single_area=True, area="houston", level="city"),
}


def dataset_paths(root: str, place: PlaceSpec) -> dict[str, str]:
    """Every file a place reads, by role."""
    base = f"{root.rstrip('/')}/{place.directory}"
    out = {f"parcels:{p.dataset}": f"{base}/{p.dataset}" for p in place.parcels}
    for ds in ("transportation_means", "transportation_type", "poverty", "occupancy", "mental_health"):
        out[ds] = f"{base}/{ds}.csv"
    for shared in ("QOL", "housing_race", "housing_financial"):
        out[shared] = f"{root.rstrip('/')}/{shared}.csv"
    return out


# The reference's feature names, in its order.
FEATURE_COLUMNS = [
    "all_residential", "sf_residential", "multi_residential", "percent_residential",
    "percent_multi", "commute_time_in_mins", "percentage_car", "percentage_public",
    "percentage_walk", "percentage_wfh", "percentage_occupancy", "percentage_vacant",
    "owner_below_poverty", "renter_below_poverty", "crime_rate", "unemployment",
    "costOfLiving", "mentalHealth", "median_income", "white_percent", "black_percent",
    "asian_percent", "latino_percent",
]

__all__ = ["PLACES", "PlaceSpec", "ParcelSource", "LabelRule", "dataset_paths", "FEATURE_COLUMNS"]
