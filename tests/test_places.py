"""End-to-end place runs on invented files shaped like the reference's
inputs (FIXTURES.md): an Ohio-like place keyed by county and a Detroit-like
city, with the hard rows (quoted commas and newlines, repeated header, NULL
label, N values, zero total, substring matches, a county without health)."""

import os

import pytest

from parcelscope.plans import place_run as R
from parcelscope.plans import places as P


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _census_line(name, values: dict, width: int) -> str:
    cells = ["0500000US0"] + [f'"{name}"'] + ["0"] * (width - 2)
    for pos, v in values.items():
        cells[pos] = f'"{v}"' if v not in ("N", "") else v
    return ",".join(cells)


def _census(path, rows, spec, width=None):
    width = width or max([1, *spec.values()]) + 3
    head = ["GEO_ID,NAME,extra", "id,Geographic Area Name,x", "codes,,"]
    body = [_census_line(n, {spec[k]: v for k, v in vals.items()}, width) for n, vals in rows]
    _write(path, "\n".join(head + body) + "\n")


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = str(tmp_path_factory.mktemp("zoning"))
    # Ohio-like parcels: county at 0, code label at 3, header line repeated
    _write(f"{r}/Ohio/ohio-parcels.csv", "\n".join([
        "county,id,x,use",
        "Adams,1,a,510: Res-Single Family", "Adams,2,a,510: Res-Single Family",
        "Adams,3,a,520: Res-Two Family", "Adams,4,a,599: Res-Custom Code",
        "Adams,5,a,410: Commercial",
        "county,id,x,use",
        "Van Wert,6,a,550: Res-Condo", "Van Wert,7,a,510: Res-Single Family",
        "Brown,8,a,410: Commercial"]) + "\n")
    ohio = [("Adams County, Ohio", "Van Wert County, Ohio")]
    _census(f"{r}/Ohio/transportation_means.csv",
            [("Adams County, Ohio", {"commute_time_in_mins": "N"}),
             ("Van Wert County, Ohio", {"commute_time_in_mins": "21.5"})], P.TRANSPORT_MEANS)
    _census(f"{r}/Ohio/transportation_type.csv",
            [("Adams County, Ohio", {"total": "100", "car": "80", "public": "5", "bicycle": "1", "walk": "4", "wfh": "10"}),
             ("Van Wert County, Ohio", {"total": "N", "car": "3", "public": "0", "bicycle": "0", "walk": "0", "wfh": "1"})],
            P.TRANSPORT_TYPE)
    _census(f"{r}/Ohio/poverty.csv",
            [("Adams County, Ohio", {"owner_pct": "5.3", "owner_moe": "1.1", "renter_pct": "20.0", "renter_moe": "3.0"}),
             ("Van Wert County, Ohio", {"owner_pct": "4.0", "owner_moe": "1.0", "renter_pct": "10.0", "renter_moe": "2.0"})],
            P.POVERTY)
    _census(f"{r}/Ohio/occupancy.csv",
            [("Adams County, Ohio", {"total": "200", "occupied": "150", "vacant": "50"}),
             ("Van Wert County, Ohio", {"total": "0", "occupied": "0", "vacant": "0"})], P.OCCUPANCY)
    _write(f"{r}/Ohio/mental_health.csv", 'County,Days\nunit,x\n"Adams",5.8\n')
    # shared files
    qol_w = max(P.QOL.values()) + 1

    def qol(key, crime, unemp, col):
        cells = [key] + [""] * (qol_w - 1)
        cells[P.QOL["crime"]] = crime
        cells[P.QOL["unemployment"]] = unemp
        cells[P.QOL["cost_of_living"]] = col
        cells[P.QOL["national_parks"]] = "1"
        cells[P.QOL["state_park_coverage"]] = "0.11%"
        return ",".join(cells)
    _write(f"{r}/QOL.csv", "\n".join([
        ",".join(["key"] + [f"h{i}" for i in range(1, qol_w)]),
        qol("OHAdams County", "11/1000", "5.68%", '"$60,510.05"'),
        qol("OHVan Wert County", "7/1000", "3.50%", '"$55,000.00"'),
        qol("MIWayne County", "42/1000", "4.86%", '"$70,843.33"'),
        qol("COAdams County", "1/1000", "1.00%", '"$1.00"')]) + "\n")
    race_rows = [(f"Other {i} County, Ohio", {}) for i in range(8)]
    race_rows[7] = ("Wayne County, Michigan", {"white_percent": "52.4", "black_percent": "36.9",
                                               "asian_percent": "2.9", "latino_percent": "5.0"})
    race_rows += [("Adams County, Ohio", {"white_percent": "96.0", "black_percent": "N",
                                          "asian_percent": "0.3", "latino_percent": "1.1"})]
    _write(f"{r}/housing_race.csv", "\n".join(
        _census_line(n, {P.RACE[k]: v for k, v in vals.items()}, max(P.RACE.values()) + 2) for n, vals in race_rows) + "\n")
    fin_rows = [(n, {P.FINANCIAL["median_income"]: "55867" if "Wayne" in n else "59880"}) for n, _ in race_rows]
    _write(f"{r}/housing_financial.csv", "\n".join(
        _census_line(n, v, P.FINANCIAL["median_income"] + 2) for n, v in fin_rows) + "\n")
    # Detroit-like city: multi-line CSV, label at _c14
    def det(i, label):
        cells = [str(i)] + ["x"] * 13 + [label]
        return ",".join(cells)
    lines = [det("id", "zoning"), det(1, "Single Family"), det(2, '"Two Family, Flat"'),
             det(3, "WAREHOUSE"), det(4, ""), det(5, '"multi\nline apt"'), det("id", "zoning")]
    _write(f"{r}/Detroit/detroit-parcels.csv", "\n".join(lines) + "\n")
    _census(f"{r}/Detroit/transportation_means.csv", [("Detroit city, Michigan", {"commute_time_in_mins": "52.3"})],
            P.TRANSPORT_MEANS)
    _census(f"{r}/Detroit/transportation_type.csv",
            [("Detroit city, Michigan", {"total": "1000", "car": "764", "public": "46", "bicycle": "1", "walk": "32", "wfh": "115"})],
            P.TRANSPORT_TYPE)
    _census(f"{r}/Detroit/poverty.csv", [("Detroit city, Michigan", {"owner_pct": "18.2", "owner_moe": "1", "renter_pct": "43.8", "renter_moe": "2"})],
            P.POVERTY)
    _census(f"{r}/Detroit/occupancy.csv", [("Detroit city, Michigan", {"total": "1000", "occupied": "820", "vacant": "180"})],
            P.OCCUPANCY)
    # rows of other counties too: the place joins none of them
    _write(f"{r}/Detroit/mental_health.csv", 'a\nb\n"Alcona",5.9\n"Wayne",5.1\n"Kent",4.4\n')
    return r


def test_ohio_zoning_profile(spark, root):
    prof = R.zoning_profile(spark, root, P.PLACES["ohio"])
    rep = {r.label: r.n for r in prof["residential_labels"].collect()}
    assert rep == {"510: res-single family": 3, "520: res-two family": 1, "599: res-custom code": 1,
                   "550: res-condo": 1, "Total": 6}
    per = {r.county: r.n for r in prof["per_county"].collect()}
    assert per == {"adams": 4, "van wert": 2}
    kept = {r.county: r.kept_total for r in prof["kept"].collect()}
    assert kept == {"adams": 3, "van wert": 2}
    alll = {r.label: r.n for r in prof["all_labels"].collect()}
    assert alll["Total"] == 8  # both header lines are dropped


def test_ohio_features(spark, root):
    ft = {r.county: r for r in R.place_features(spark, root, P.PLACES["ohio"]).collect()}
    assert set(ft) == {"adams", "van wert"}
    a = ft["adams"]
    assert (a.all_residential, a.sf_residential, a.multi_residential) == (3, 2, 1)
    assert abs(a.percent_residential - 2 / 3) < 1e-12
    assert a.commute_time_in_mins == 0.0  # "N" -> missing -> zero-filled
    assert (a.percentage_car, a.percentage_wfh) == (0.8, 0.1)
    assert abs(a.owner_below_poverty - 0.053) < 1e-12
    assert (a.percentage_occupancy, a.percentage_vacant) == (0.75, 0.25)
    assert (a.crime_rate, a.costOfLiving) == (11.0, 60510.05)
    assert abs(a.unemployment - 0.0568) < 1e-12
    assert a.mentalHealth == 5.8
    assert (a.white_percent, a.black_percent, a.median_income) == (96.0, 0.0, 59880.0)
    v = ft["van wert"]
    assert v.percentage_car == 3.0  # missing total counts as 1
    assert v.percentage_occupancy == 0.0  # total 0 -> missing -> zero-filled
    assert v.mentalHealth == 0.0  # no health row


def test_city_place(spark, root):
    place = P.PLACES["detroit"]
    prof = R.zoning_profile(spark, root, place)
    rep = {r.label: r.n for r in prof["residential_labels"].collect()}
    # 'warehouse' holds 'house'; the NULL label is counted as 'null'
    assert rep == {"single family": 1, "two family, flat": 1, "warehouse": 1, "multi\nline apt": 1, "Total": 4}
    alll = {r.label: r.n for r in prof["all_labels"].collect()}
    assert alll["null"] == 1 and alll["Total"] == 5
    ft = R.place_features(spark, root, place).collect()
    assert len(ft) == 1
    d = ft[0]
    assert (d.state, d.county, d.all_residential, d.sf_residential) == ("michigan", "detroit", 4, 1)
    assert d.level == "city"
    assert d.commute_time_in_mins == 52.3 and abs(d.percentage_public - 0.046) < 1e-12
    assert (d.crime_rate, d.white_percent, d.median_income) == (42.0, 52.4, 55867.0)
    assert d.mentalHealth == 0.0


def test_catalog_of_paths():
    paths = P.dataset_paths("/data/zoning", P.PLACES["colorado"])
    assert paths["parcels:weld-parcels.csv"] == "/data/zoning/Colorado/weld-parcels.csv"
    assert paths["QOL"] == "/data/zoning/QOL.csv"


def test_analysis_on_feature_table(spark):
    from parcelscope.plans import analysis
    from parcelscope.plans import features as feat
    ft = feat.county_features(spark, "/root/testdata/sf0.001")
    res = analysis.analyze(spark, ft, feat.KEY, feat.FEATURES, min_share=0.0, k=3, ks=range(1, 4), restarts=2)
    assert res["summary"].count() > 0
    assert res["top_single"].count() == 5
    assert [r.k for r in res["elbow"].collect()] == [1, 2, 3]
    assert res["clusters"].count() == ft.filter("all_residential > 1").count()
    best = res["best"].collect()
    assert best and all(1 <= r.best_degree <= 4 for r in best)
    assert res["curves"].count() == 1000 * res["best"].count()


def _quoted_row(width, label_pos, label):
    cells = [f"v{i}" for i in range(width)]
    cells[1] = '"Main St, Unit 4"'  # a quoted comma before the label
    cells[label_pos] = label
    return ",".join(cells)


def test_colorado_quoted_sources(spark, tmp_path):
    r = str(tmp_path)
    _write(f"{r}/Colorado/denver-parcels.csv", "\n".join(
        ["h" * 5, _quoted_row(53, 51, "Single Family"), _quoted_row(53, 51, '"apt mid-rise>9 unt,1-9sty"'),
         _quoted_row(53, 51, "Single Family Misc/Liv"),
         _quoted_row(53, 51, "Office")]) + "\n")
    _write(f"{r}/Colorado/jefferson-parcels.csv", "\n".join(
        ["header", "Duplex: Two Family,x,y", "Commercial,x,y", "Single Family,,"]) + "\n")
    _write(f"{r}/Colorado/weld-parcels.csv", "\n".join(
        ["header", _quoted_row(35, 33, "Mobile Home"), _quoted_row(35, 33, "Warehouse"),
         _quoted_row(35, 33, "Single Family Residential on Ag"),
         _quoted_row(35, 33, "Secondary Single Family Res")]) + "\n")
    prof = R.zoning_profile(spark, r, P.PLACES["colorado"])
    per = {r_.county: r_.n for r_ in prof["per_county"].collect()}
    assert per == {"denver": 3, "jefferson": 2, "weld": 4}
    labels = {r_.label: r_.n for r_ in prof["residential_labels"].collect()}
    assert labels == {"single family": 2, '"apt mid-rise>9 unt,1-9sty"': 1, "duplex: two family": 1,
                      "mobile home": 1, "warehouse": 1, "single family misc/liv": 1,
                      "single family residential on ag": 1, "secondary single family res": 1, "Total": 9}
    mix = {r_.county: (r_.all_residential, r_.sf_residential)
           for r_ in R.housing_mix(spark, r, P.PLACES["colorado"]).collect()}
    # Denver counts its exact label only, Weld no secondary homes
    assert mix == {"denver": (3, 1), "jefferson": (2, 1), "weld": (4, 1)}


def test_write_outputs_and_read_back(spark, root, tmp_path):
    from parcelscope.plans.place_outputs import write_place_outputs
    from parcelscope.sources import files, results
    out = str(tmp_path / "outputs-ohio")
    paths = write_place_outputs(spark, root, P.PLACES["ohio"], out)
    rep = [r.value for r in spark.read.text(paths["countOfAllResidentialInOhio"]).collect()]
    assert rep[0] == "Count of all types of Residential in Ohio" and rep[-1] == "Total: 6"
    pairs = [r.value for r in spark.read.text(paths["countOfAllResidentialByCounty"]).collect()]
    assert pairs == ["(adams,4)", "(van wert,2)"]
    hist = [r.value for r in spark.read.text(paths["relevantResidentialByCounty"]).collect()]
    assert hist[0] == "(adams,[(510: res-single family,2), (520: res-two family,1)])"
    occ = results.parse_result_lines(spark, paths["occupancyByCounty"],
                                     ["percentage_occupancy", "percentage_vacant"]).collect()
    assert {(r.key, r.percentage_occupancy) for r in occ} == {("adams", "0.75"), ("van wert", "null")}
    rec = results.record_block_pivot(files.read_lines(spark, paths["allQualitiesPlusHealth"]), 7,
                                     ["key", "crime", "unemp", "parks", "coverage", "cost", "health"]).orderBy("record")
    first, second = rec.collect()
    assert first.key == "(adams," and first.crime == "\tcrimeRate:11.0"
    assert first.parks == "\tnationalParkCount:1" and first.coverage == "\tstateParkCoverage:0.0011"
    assert first.cost == "\tcostOfLiving:60510.05" and first.health == "\tmentalHealth:5.8)"
    assert second.key == "(van wert," and second.health == "\tmentalHealth:0.0)"
    pov = [r.value for r in spark.read.text(paths["percentPovertyByCounty"]).collect()]
    assert "below_poverty_owner:5.3±1.1" in pov[0] and "below_poverty_renter:20.0±3.0" in pov[0]
    modes = [r.value for r in spark.read.text(paths["commuteTypesByCounty"]).collect()]
    assert "commuters:100.0" in modes[0] and "percentage_bicycle:0.01" in modes[0]


def test_shared_files_are_scanned_once_for_all_places(spark, root):
    names = ["ohio", "detroit"]
    key = lambda r: (r.state, r.county)
    got = sorted(R.feature_table(spark, root, names).collect(), key=key)
    want = sorted((r for n in names for r in R.place_features(spark, root, P.PLACES[n]).collect()), key=key)
    assert got == want and len(got) == 3
    plan = R.feature_table(spark, root, names)._jdf.queryExecution().executedPlan().toString()
    assert not any(f in plan for f in ("housing_race.csv", "housing_financial.csv", "QOL.csv"))  # their rows were written once
    shared = R.nationwide(spark, root, [P.PLACES[n] for n in names])
    assert {r.row for r in shared["housing_race"].collect()} <= {
        i for n in names for i in range(*P.PLACES[n].nationwide_rows)}


def test_nothing_stays_cached(spark, root, tmp_path):
    from parcelscope.plans.place_outputs import write_place_outputs
    from parcelscope.sources import sinks
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = held()
    write_place_outputs(spark, root, P.PLACES["ohio"], str(tmp_path / "out"))
    assert held() == before
    with pytest.raises(ZeroDivisionError), sinks.reused(spark.range(10)) as kept:
        assert kept.count() == 10 and held() == before + 1
        raise ZeroDivisionError
    assert held() == before


def test_cli_place_and_analysis(spark, root, tmp_path):
    from parcelscope import cli
    out = str(tmp_path / "cli")
    assert cli.main(["place", "detroit", "--root", root, "--out", f"{out}/detroit"]) == 0
    # title, 4 labels (one holds a newline, so it spans two lines) and the total
    assert spark.read.text(f"{out}/detroit/countOfAllResidentialInDetroit").count() == 7
    assert cli.main(["analysis", "--root", root, "--out", f"{out}/analysis", "--places", "ohio,detroit"]) == 0
    stats = spark.read.option("header", True).csv(f"{out}/analysis/allStats")
    assert stats.count() == 3 and len(stats.columns) == 26
    assert {r.level for r in stats.select("level").collect()} == {"county", "city"}
    assert spark.read.parquet(f"{out}/analysis/summary").count() > 0
    assert spark.read.parquet(f"{out}/analysis/clusters").count() == 3
