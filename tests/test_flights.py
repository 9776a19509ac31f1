"""The flight pipeline end to end on a hand-made miniature of its input schemas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventfeat.plans import flights as FL

_NUM = {"CRS_ELAPSED_TIME": 120.0, "ACTUAL_ELAPSED_TIME": 130.0, "AIR_TIME": 100.0, "DISTANCE": 700.0,
        "DISTANCE_GROUP": 3, "DEP_DEL15": 0.0, "TAXI_OUT": 10.0, "TAXI_IN": 5.0, "WHEELS_OFF": 1000, "WHEELS_ON": 1200,
        "CARRIER_DELAY": None, "WEATHER_DELAY": None, "NAS_DELAY": None, "SECURITY_DELAY": None, "LATE_AIRCRAFT_DELAY": None}


def _flight(fl_date, tail, fln, orig, dest, crs_dep, dep, dep_delay, crs_arr, arr, arr_delay, arr_del15,
            cancelled=0.0, diverted=0.0):
    d = dt.date.fromisoformat(fl_date)
    row = {c: None for c in FL.FLIGHT_KEEP}
    row.update({"YEAR": d.year, "QUARTER": (d.month - 1) // 3 + 1, "MONTH": d.month, "DAY_OF_MONTH": d.day,
                "DAY_OF_WEEK": d.isoweekday(), "FL_DATE": fl_date, "OP_UNIQUE_CARRIER": "AA", "TAIL_NUM": tail,
                "OP_CARRIER_FL_NUM": fln, "ORIGIN": orig, "DEST": dest, "ORIGIN_STATE_ABR": "NY", "DEST_STATE_ABR": "IL",
                "CRS_DEP_TIME": crs_dep, "DEP_TIME": dep, "DEP_DELAY": dep_delay, "CRS_ARR_TIME": crs_arr, "ARR_TIME": arr,
                "ARR_DELAY": arr_delay, "ARR_DEL15": arr_del15, "CANCELLED": cancelled, "DIVERTED": diverted,
                "DEP_TIME_BLK": "x", "ARR_TIME_BLK": "y"})
    row.update(_NUM)
    return row


SCHEMA = ", ".join(
    f"{c} {'string' if c in ('FL_DATE', 'OP_UNIQUE_CARRIER', 'TAIL_NUM', 'ORIGIN', 'DEST', 'ORIGIN_CITY_NAME', 'DEST_CITY_NAME', 'ORIGIN_STATE_ABR', 'DEST_STATE_ABR', 'ORIGIN_STATE_NM', 'DEST_STATE_NM', 'DEP_TIME_BLK', 'ARR_TIME_BLK') else ('int' if c in ('YEAR', 'QUARTER', 'MONTH', 'DAY_OF_MONTH', 'DAY_OF_WEEK', 'OP_CARRIER_FL_NUM', 'ORIGIN_CITY_MARKET_ID', 'DEST_CITY_MARKET_ID', 'ORIGIN_STATE_FIPS', 'DEST_STATE_FIPS', 'ORIGIN_WAC', 'DEST_WAC', 'DISTANCE_GROUP', 'WHEELS_OFF', 'WHEELS_ON', 'CRS_DEP_TIME', 'DEP_TIME', 'CRS_ARR_TIME', 'ARR_TIME') else 'double')}"
    for c in dict.fromkeys(FL.FLIGHT_KEEP))


def build_inputs(spark):
    rows = [
        _flight("2019-07-03", "N1", 10, "JFK", "ORD", 800, 805, 5.0, 1000, 1010, 10.0, 0.0),
        _flight("2019-07-03", "N1", 11, "ORD", "JFK", 1300, 1330, 30.0, 1600, 1640, 40.0, None),
        _flight("2019-07-03", "N1", 11, "ORD", "JFK", 1300, 1330, 30.0, 1600, 1640, 40.0, None),  # duplicate row
        _flight("2019-07-04", "N2", 12, "JFK", "ORD", 2359, 15, 16.0, 200, 2400, 20.0, 1.0),
        _flight("2019-07-05", "N2", 13, "ORD", "SJU", 900, 900, 0.0, 1300, 1300, 0.0, 0.0),           # non-US dest
        _flight("2019-07-05", "N3", 14, "ORD", "JFK", 900, None, None, 1200, None, None, None, cancelled=1.0),
    ]
    cols = list(dict.fromkeys(FL.FLIGHT_KEEP))
    flights = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SCHEMA)
    wcols = FL.WEATHER_KEEP
    def obs(station, date, sky, wx, wind):
        r = {c: None for c in wcols}
        r.update({"STATION": station, "DATE": date, "NAME": "SOMEWHERE US", "HourlySkyConditions": sky,
                  "HourlyPresentWeatherType": wx, "HourlyWindDirection": wind, "HourlyWindSpeed": "7",
                  "HourlySeaLevelPressure": "30.01"})
        return tuple(r[c] for c in wcols)
    weather = spark.createDataFrame([
        obs("S_JFK", "2019-07-03T10:51:00", "BKN:07 050", "-RA:02", "200"),
        obs("S_JFK", "2019-07-03T11:30:00", "OVC:08 010", "TSRA", "VRB"),   # too close to departure (1 h lead)
        obs("S_ORD", "2019-07-03T15:00:00", "FEW:02 025", "", "0"),
        obs("S_ORD", "2019-07-03T16:59:00", "SCT:04 030", "BR", "45"),
    ], ", ".join(f"{c} string" for c in wcols))
    stations = spark.createDataFrame([
        ("S_JFK", "KJFK", 1.5), ("S_JFK2", "KJFK", 9.0), ("S_ORD", "KORD", 2.0), ("S_X", "KXXX", 1.0)],
        "station_id string, neighbor_call string, distance_to_neighbor double")
    airports = spark.createDataFrame([
        ("KJFK", "JFK", "US", "40.64, -73.78", 13.0, "large_airport"),
        ("KORD", "ORD", "US", "41.98, -87.90", 672.0, "large_airport"),
        ("TJSJ", "SJU", "US", "18.44, -66.00", 9.0, "large_airport")],
        "icao_code string, iata_code string, iso_country string, coordinates string, elevation_ft double, type string")
    zones = spark.createDataFrame([(1, "America/New_York", 40.71, -74.0), (2, "America/Chicago", 41.88, -87.63)],
                                  "zone_id int, zone string, zone_lat double, zone_lon double")
    return flights, weather, stations, airports, zones


@pytest.fixture(scope="module")
def inputs(spark):
    return build_inputs(spark)


@pytest.fixture(scope="module")
def stages(spark, inputs):
    """Each stage is written as parquet and read back, as between the source's
    notebooks: plans stay short and every stage survives executor loss."""
    from eventfeat.sources import io as IO

    def stage(df, name):
        return spark.read.parquet(IO.write_stage(df, IO.scratch_path(spark, name)))

    flights, weather, stations, airports, zones = inputs
    fl = stage(FL.clean_flights(flights, FL.calendar(spark)), "fl")
    ap, backup = FL.airport_stations(stations, airports, fl)
    ap, backup = stage(ap, "ap"), stage(backup, "backup")
    full = stage(FL.enrich_and_localize(fl, ap, backup, zones), "full")
    joined = stage(FL.final_join(full, FL.clean_weather(weather)), "final_join")
    pre = stage(FL.preprocess(joined), "preprocessed")
    return {"fl": fl, "ap": ap, "full": full, "joined": joined, "pre": pre}


def test_clean_and_airports(stages):
    fl, ap = stages["fl"], stages["ap"]
    assert fl.count() == 3                      # dup, cancelled and non-US removed
    rows = fl.collect()
    assert "2019-07-03_0800_N1_10_JFK_ORD" in {r["FLIGHT_ID"] for r in rows}
    hol = {r["FLIGHT_ID"][:10]: r["IS_US_HOLIDAY"] for r in rows}
    assert hol["2019-07-03"] == 1 and hol["2019-07-04"] == 1
    assert {r["iata_code"]: r["station_id"] for r in ap.collect()} == {"JFK": "S_JFK", "ORD": "S_ORD"}


def test_enrich_and_localize(stages):
    full = stages["full"]
    r0 = full.filter(F.col("OP_CARRIER_FL_NUM") == 10).first()
    assert r0["STATION"] == "S_JFK" and str(r0["CRS_DEP_DATETIME_UTC"]) == "2019-07-03 12:00:00"   # EDT = UTC-4
    assert str(r0["CRS_ARR_DATETIME_UTC"]) == "2019-07-03 15:00:00"                                # CDT = UTC-5
    r3 = full.filter(F.col("OP_CARRIER_FL_NUM") == 12).first()
    assert str(r3["DEP_DATETIME_UTC"]) == "2019-07-05 04:15:00"  # departed after midnight: next day
    assert r3["ARR_HOUR"] == 24


def test_zones_by_border_localize_alike(spark, inputs, stages):
    """Zone borders in place of reference points: the same local times here, and an airport
    nearer to the other zone's point keeps the zone around it."""
    box = {1: ("America/New_York", -85, -60), 2: ("America/Chicago", -100, -85)}
    borders = spark.createDataFrame(
        [(z, name, 0, k, float(y), float(x)) for z, (name, a, b) in box.items() for k, (x, y) in enumerate([(a, 25), (b, 25), (b, 50), (a, 50)])],
        "zone_id int, zone string, ring int, seq int, lat double, lon double")
    _, backup = FL.airport_stations(inputs[2], inputs[3], stages["fl"])
    full = FL.enrich_and_localize(stages["fl"], stages["ap"], backup, borders)
    cols = ["FLIGHT_ID", "CRS_DEP_DATETIME_UTC", "CRS_ARR_DATETIME_UTC"]
    assert sorted(full.select(*cols).collect()) == sorted(stages["full"].select(*cols).collect())


def test_final_join(stages):
    joined = stages["joined"]
    assert joined.count() == 3
    m = {r["OP_CARRIER_FL_NUM"]: r for r in joined.collect()}
    assert str(m[10]["MATCHED_OBS_TIME_UTC"]) == "2019-07-03 10:51:00" and m[10]["light"] == 1
    assert m[10]["rain_or_drizzle"] == 1 and m[10]["has_bkn"] == 1
    assert str(m[11]["MATCHED_OBS_TIME_UTC"]) == "2019-07-03 16:59:00" and m[11]["reduced_visibility"] == 1
    assert FL.weather_match_rate(joined).first().asDict() == {"matched": 2, "total": 3}


def test_preprocess(stages):
    pre = stages["pre"]
    p = {r["OP_CARRIER_FL_NUM"]: r for r in pre.collect()}
    # N1 flight 11 departs 13:00 CDT = 18:00 UTC; the previous leg arrived 15:10 UTC (> 1h01 before): lag kept
    assert p[11]["prev_flight_arr_delay_clean"] == 10.0
    assert p[11]["actual_to_crs_time_to_next_flight_diff_mins_clean"] == pytest.approx(170.0)
    assert p[11]["ARR_DEL15"] == 0                    # imputed: actual - scheduled elapsed = 10 < 15
    assert FL.leakage_check(pre).first()["prev_flight_arr_delay_clean_violations"] == 0
    model = FL.model_table(pre)
    assert len(model.columns) == 58
    assert model.filter(F.col("origin_pagerank").isNull()).count() == 0
    assert p[10]["HourlyWindCardinalDirection"] == "S" and p[12]["HourlyWindCardinalDirection"] == "Calm"


def test_splits_folds_and_fold_processing(spark, stages):
    import datetime as dt
    from eventfeat.operators.split import rolling_windows
    pre = stages["pre"]
    assert {r["split"] for r in FL.train_test(pre, "1y").collect()} == {"train"}   # Jan-Sep 2019 is train
    span = spark.createDataFrame([(dt.datetime(2019, 1, 1),), (dt.datetime(2019, 9, 30),)], "CRS_DEP_DATETIME_UTC timestamp_ntz")
    assert rolling_windows(span, "CRS_DEP_DATETIME_UTC", 3, 1, 1).count() == 6
    model = FL.model_table(pre).withColumn("FLIGHT_ID", F.col("TAIL_NUM"))
    tr, va, pm, logged = FL.process_fold(model, model, downsample_ratio=None)
    row = tr.select("log_scaled_features", "log_unscaled_features", "full_unscaled_features").first()
    assert row[0].size == row[1].size == row[2].size
    assert va.count() == model.count()


def test_run_stages_writes_every_stage(spark, inputs):
    import os
    from eventfeat.sources import io as IO
    flights, weather, stations, airports, zones = inputs
    root = IO.scratch_path(spark, "run")
    src = {}
    for name, df in (("flights", flights), ("weather", weather), ("stations", stations)):
        src[name] = f"{root}/in/{name}"
        df.write.parquet(src[name])
    src["airports"] = f"{root}/in/airports_csv"
    airports.write.option("header", True).csv(src["airports"])
    paths = FL.run_stages(spark, src["flights"], src["weather"], src["stations"], src["airports"], zones,
                          f"{root}/run", horizon="1y")
    assert spark.read.parquet(paths["final_join"]).count() == 3
    pre = spark.read.parquet(paths["preprocessed"])
    assert pre.count() == 3 and pre.columns == ["FLIGHT_ID", *FL.MODEL_COLS]     # no audit columns
    done = spark.read.parquet(paths["processed_train_test"] + "/split=train")
    assert done.count() == 3 and spark.read.parquet(paths["processed_train_test"] + "/split=test").count() == 0
    for stage in ("final_join", "preprocessed", "train_test"):
        FL.check_stage(spark.read.parquet(paths[stage]), stage)
    FL.check_stage(done, "processed")
    tt = spark.read.parquet(paths["train_test"])
    assert {r["split"] for r in tt.select("split").distinct().collect()} == {"train"}
    root_of = paths["final_join"].rsplit("/", 1)[0]
    assert root_of.endswith("run_1y/final_join") and IO.current_version(spark, root_of) == paths["final_join"]
    assert not os.path.exists(paths["processed"].replace("file:", ""))   # no fold fits in 2 days of data


def test_stage_contract_names_what_differs(spark, stages):
    with pytest.raises(ValueError, match="FLIGHT_ID: missing"):
        FL.check_stage(FL.model_table(stages["pre"]), "preprocessed")
    with pytest.raises(ValueError, match="fold: string, not int"):
        FL.check_stage(spark.createDataFrame([("1", "train", "x")], "fold string, role string, FLIGHT_ID string"), "rolling_windows")


def test_train_sweep_and_blind_test(spark, stages):
    """On processed stages made of many copies of the test flights with a label that the
    distance tells."""
    from eventfeat.sources import io as IO
    many = FL.model_table(stages["pre"], keep=["FLIGHT_ID"]).crossJoin(spark.range(60).withColumnRenamed("id", "n"))
    many = many.withColumns({"FLIGHT_ID": F.concat_ws("_", "FLIGHT_ID", "n"), "ARR_DEL15": F.pmod("n", F.lit(2)).cast("int")}).withColumn(
        "DISTANCE", (F.col("ARR_DEL15") * 900 + F.pmod(F.col("n") * 37, F.lit(100))).cast(stages["pre"].schema["DISTANCE"].dataType))
    cut = {"train": many.filter("n < 40").drop("n"), "val": many.filter("n >= 40").drop("n")}
    root = IO.scratch_path(spark, "blind")
    path = {n: f"{root}/{n}" for n in ("rolling_windows", "processed", "processed_train_test", "metrics")}
    tr, va, _, _ = FL.process_fold(cut["train"], cut["val"], downsample_ratio=None)
    tagged = [cut[r].withColumns({"fold": F.lit(1), "role": F.lit(r)}) for r in cut]
    IO.write_stage(tagged[0].unionByName(tagged[1]), path["rolling_windows"], partition_by=["fold", "role"])
    for role, name, df in (("train", "train", tr), ("val", "test", va)):
        IO.write_stage(df, f"{path['processed']}/fold=1/role={role}")
        IO.write_stage(df, f"{path['processed_train_test']}/split={name}")
    got = FL.train_and_test(spark, path, max_iter=30).first()
    assert got["roc_auc"] > 0.95 and got["tp"] + got["fp"] + got["fn"] + got["tn"] == 60
    log = IO.metric_history(spark, path["metrics"])
    assert {r["fold"] for r in log.select("fold").distinct().collect()} == {1, -1}
    assert log.filter("name = 'f2'").count() == 1 and log.filter("name = 'roc_auc' AND fold = -1").count() == 1
