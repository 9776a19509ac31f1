"""Quirks of the coded-text parsers and clock helpers."""

import pytest
from pyspark.sql import functions as F

from eventfeat.functions import codes as CD
from eventfeat.functions import numeric as N
from eventfeat.functions import timecols as TC


def _wx(spark, text):
    df = spark.createDataFrame([(text,)], "wx string")
    return CD.parse_codes(df, "wx", keep_tokens=True).first().asDict()


@pytest.mark.parametrize("text,flag,expected", [
    ("TS:7", "thunderstorm", 0), ("VCTS:7", "thunderstorm", 0), ("+TSRA", "thunderstorm", 1),
    ("-TSRA:02", "thunderstorm", 1), ("FZFG:2", "freezing_conditions", 1), ("FZFG:2", "reduced_visibility", 0),
    ("-RA:02 BR:1", "light", 1), ("|RA:02|", "rain_or_drizzle", 1), ("null", "rain_or_drizzle", 0),
    ("SQ", "thunderstorm", 1), ("PR", "reduced_visibility", 1), ("UP:01", "unknown_precip", 1),
])
def test_weather_flags(spark, text, flag, expected):
    assert _wx(spark, text)[flag] == expected


def test_mifg_sets_no_flag(spark):
    r = _wx(spark, "MIFG")
    assert all(r[f] == 0 for f in CD.WEATHER_RULES) and r["ReadableWeather"] == ""


def test_empty_text_gives_one_empty_token(spark):
    r = _wx(spark, None)
    assert r["tokens"] == [""] and all(r[f] == 0 for f in CD.WEATHER_RULES)


def test_label_order(spark):
    assert _wx(spark, "-RA:02 BR:1")["ReadableWeather"] == "light_weather rain_or_drizzle reduced_visibility"


def test_sky_layers_positional_zip(spark):
    df = spark.createDataFrame([("VV:09 012",), ("SCT:04 030 BKN:07 080",), ("OVC:08",), ("",)], "sky string")
    rows = CD.parse_layers(df, "sky", extra=True).collect()
    vv, sb, ovc, empty = rows
    assert vv["layers"][0]["code"] is None and vv["layers"][0]["base_ft_agl"] == 1200
    assert vv["has_few"] is None and vv["misaligned"] == 1 and vv["ceiling_ft"] == 0
    assert sb["has_sct"] == 1 and sb["has_bkn"] == 1 and sb["ceiling_ft"] == 8000 and sb["lowest_cloud_ft"] == 3000
    assert sb["overall_cloud_frac_0_1"] == 7 / 8
    assert ovc["lowest_cloud_ft"] is None and ovc["mean_cloud_ft"] is None
    assert empty["overall_cloud_frac_0_1"] == 0.0 and empty["sky_missing"] == 1


def test_clock_helpers(spark):
    df = spark.createDataFrame([(2400.0, "2024-01-05"), (934.0, "2024-01-05"), (5.0, "2024-01-05")], "t double, d string")
    r = df.select(TC.hour_of("t").alias("h"), TC.normalize_2400(F.col("t").cast("int")).alias("n"),
                  TC.hour_block(F.col("t")).alias("b"), TC.compose_timestamp("d", "t").alias("ts")).collect()
    assert [x["h"] for x in r] == [24, 9, 0]
    assert [x["n"] for x in r] == [0, 934, 5]
    assert [x["b"] for x in r] == ["2400-2459", "0900-0959", "0000-0059"]
    assert str(r[1]["ts"]) == "2024-01-05 09:34:00" and str(r[0]["ts"]) == "2024-01-05 00:00:00"


def test_compass_edges(spark):
    df = spark.createDataFrame([(None,), (0.0,), (360.0,), (337.5,), (22.4,), (22.5,), (200.0,), (-5.0,)], "d double")
    got = [r[0] for r in df.select(N.compass("d")).collect()]
    assert got == ["Calm", "Calm", "Calm", "N", "N", "NE", "S", "N"]


def test_focal_loss_matches_formula(spark):
    import math
    df = spark.createDataFrame([(0.9, 1), (0.2, 1), (0.3, 0)], "p double, y int")
    got = [r[0] for r in df.select(N.focal_loss(p="p", y="y", alpha=0.75, gamma=2.0)).collect()]
    def fl(p, y):
        pt = p if y else 1 - p
        at = 0.75 if y else 0.25
        return at * (1 - pt) ** 2 * -math.log(pt)
    assert got == pytest.approx([fl(0.9, 1), fl(0.2, 1), fl(0.3, 0)])
    z = [2.0, -1.0]
    lg = spark.createDataFrame([(z[0], 1), (z[1], 0)], "z double, y int")
    got2 = [r[0] for r in lg.select(N.focal_loss(y="y", logit="z")).collect()]
    s = [1 / (1 + math.exp(-v)) for v in z]
    assert got2 == pytest.approx([fl(s[0], 1), fl(s[1], 0)])
