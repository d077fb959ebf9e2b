"""Column functions (P1-P24) on invented rows with the hard cases."""

import math

from pyspark.sql import functions as F

from parcelscope import functions as fn


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_split_pick_breaks_quoted_name(spark):
    line = '1,"Adams County, Ohio",5,10'
    assert one(spark, fn.split_pick("v", 1), line) == '"Adams County'
    # every position after the quoted name moves by one
    assert one(spark, fn.split_pick("v", 3), line) == "5"
    assert one(spark, fn.split_pick("v", 9), line) is None


def test_split_quoted_keeps_or_drops_trailing_empties(spark):
    line = '"Adams County, Ohio",12,,'
    arr = one(spark, fn.split_quoted("v"), line)
    assert arr == ['"Adams County, Ohio"', "12", "", ""]
    arr0 = one(spark, fn.split_quoted("v", keep_trailing_empty=False), line)
    assert arr0 == ['"Adams County, Ohio"', "12"]


def test_csv_fields_parses_quotes(spark):
    r = one(spark, fn.csv_fields("v", 3), 'a,"b, c",d')
    assert (r["_c0"], r["_c1"], r["_c2"]) == ("a", "b, c", "d")


def test_clean_key_and_suffix(spark):
    df = spark.createDataFrame([('"OHAdams County"',), ("COJefferson County",)], "v string")
    st, co = fn.clean_key("v")
    rows = df.select(st.alias("s"), co.alias("c")).collect()
    assert [(r.s, r.c) for r in rows] == [("OH", "adams"), ("CO", "jefferson")]
    assert one(spark, fn.strip_suffix("v"), "Van Wert County") == "van wert"


def test_null_label_and_lower(spark):
    assert one(spark, fn.null_label("v"), None) == "null"
    assert one(spark, fn.lower_label("v"), "Single FAMILY") == "single family"


def test_parsers_tolerate_bad_text(spark):
    assert one(spark, fn.parse_int("v"), '"42"') == 42
    assert one(spark, fn.parse_int("v"), "N") is None
    assert one(spark, fn.parse_double("v"), ' "3.5" ') == 3.5
    assert one(spark, fn.parse_double("v"), "x1") is None


def test_sentinel_zero(spark):
    for text, want in [("N", 0.0), ("null", 0.0), ("", 0.0), ("abc", 0.0), ('"2.5"', 2.5), (None, 0.0)]:
        assert one(spark, fn.sentinel_zero("v"), text) == want


def test_ratio_zero_and_missing_total(spark):
    df = spark.createDataFrame([(3, 0), (3, None), (3, 4)], "p int, t int")
    got = [r[0] for r in df.select(fn.ratio("p", "t")).collect()]
    assert got == [None, None, 0.75]
    guarded = [r[0] for r in df.select(fn.share_with_guard("p", "t")).collect()]
    assert guarded == [None, 3.0, 0.75]


def test_text_numbers(spark):
    assert math.isclose(one(spark, fn.percent_text("v"), "3.19%"), 0.0319)
    assert one(spark, fn.currency_text("v"), '"$91,534.85"') == 91534.85
    assert one(spark, fn.ratio_text("v"), "42/1000") == 42.0
    assert one(spark, fn.ratio_text("v"), "bad") is None


def test_estimate_margin_text(spark):
    df = spark.createDataFrame([("5.3", "0.4")], "v string, m string")
    assert df.select(fn.estimate_margin_text("v", "m")).first()[0] == "5.3±0.4"


def test_first_match_count_uses_stored_order(spark):
    df = spark.createDataFrame(
        [([("510: Res-Single Family", 7), ("520: Single Two", 3)],)],
        "h array<struct<label:string,n:bigint>>")
    assert df.select(fn.first_match_count("h", "Single")).first()[0] == 7
    assert df.select(fn.first_match_count("h", "Condo")).first()[0] is None


def test_housing_mix(spark):
    df = spark.createDataFrame([(10, 7), (0, 0)], "t long, s long")
    m = fn.housing_mix("t", "s")
    rows = df.select(m["multi"], m["single_share"], m["multi_share"]).collect()
    assert tuple(rows[0]) == (3, 0.7, 0.3)
    assert tuple(rows[1]) == (0, None, None)


def test_strict_parse_throws_like_the_reference(spark):
    import pytest
    df = spark.createDataFrame([("N",)], "v string")
    with pytest.raises(Exception):
        df.select(fn.parse_int("v", strict=True)).collect()
    assert df.select(fn.parse_int("v")).first()[0] is None
