"""Boundary tables for the CASE rules (every threshold ± epsilon and NULL)."""

from datetime import datetime

from pyspark.sql import functions as F

from millstone.functions import classify as K
from millstone.functions.payload import json_int, key_count, key_present, text_flag, text_int


def col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_iso_zone_bounds(spark):
    vals = [None, 0.0, 1.79, 1.8, 4.49, 4.5, 11.19, 11.2, 50.0]
    got = [r[0] for r in col(spark, vals, "double").select(K.iso_zone("x")).collect()]
    assert got == [None, "A", "A", "B", "B", "C", "C", "D", "D"]


def test_motor_state(spark):
    df = spark.createDataFrame([(False, 500.0), (True, 101.0), (True, 100.0), (True, 0.5), (True, 0.0),
                                (None, None), (True, -3.0), (None, 150.0)], "a boolean, rpm double")
    got = [r[0] for r in df.select(K.motor_state("a", "rpm")).collect()]
    assert got == ["OFFLINE", "RUNNING", "STARTING_STOPPING", "STARTING_STOPPING", "IDLE", "IDLE", "IDLE", "RUNNING"]


def test_downtime_category(spark):
    df = spark.createDataFrame([(800, 800000), (801, None), (803, 803105), (803, 803101), (803, None),
                                (None, None), (5, 5000)], "s long, st long")
    got = [r[0] for r in df.select(K.downtime_category("s", "st")).collect()]
    assert got == ["PRODUCTIVE", "PLANNED_STOP", "EXCLUDED", "UNPLANNED_DOWNTIME", "UNPLANNED_DOWNTIME",
                   "UNKNOWN", "UNKNOWN"]


def test_is_producing(spark):
    df = spark.createDataFrame([(800, 1, "ACTIVE_PRODUCER"), (800, 0, "ACTIVE_PRODUCER"),
                                (800, None, "ACTIVE_PRODUCER"), (800, 5, "ALWAYS_RUNNING"), (801, 5, "ACTIVE_PRODUCER"),
                                (None, 3, "ACTIVE_PRODUCER")], "s long, d long, c string")
    got = [r[0] for r in df.select(K.is_producing("s", "d", "c")).collect()]
    assert got == [True, False, False, False, False, False]


def test_shift_minutes(spark):
    mins = [44, 45, 584, 585, 764, 765, 1304, 1305, 0, 1439]
    ts = [datetime(2024, 1, 1, m // 60, m % 60, 59) for m in mins]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz").select(K.shift_name("t")).collect()]
    assert got == ["Night OT", "Day", "Day", "Day OT", "Day OT", "Night", "Night", "Night OT", "Night OT", "Night OT"]


def test_peak_and_weekend(spark):
    # 2024-01-05 is a Friday, 2024-01-06 a Saturday
    ts = [datetime(2024, 1, 5, 8, 59), datetime(2024, 1, 5, 9, 0), datetime(2024, 1, 5, 21, 59),
          datetime(2024, 1, 5, 22, 0), datetime(2024, 1, 6, 12, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = [(r[0], r[1]) for r in df.select(K.is_peak_hour("t"), K.is_weekend("t")).collect()]
    assert got == [(False, False), (True, False), (True, False), (False, False), (False, True)]


def test_quarantine_reason(spark):
    df = spark.createDataFrame([("BAD", 4), ("BAD", 10), ("BAD", None), ("GOOD", 5), ("GOOD", None), (None, 3)],
                               "q string, n int")
    got = [r[0] for r in df.select(K.quarantine_reason("q", "n")).collect()]
    assert got == ["SPARSE_PAYLOAD", "QUALITY_BAD", "QUALITY_BAD", "SPARSE_PAYLOAD", "UNROUTABLE", "SPARSE_PAYLOAD"]


def test_source_period(spark):
    got = [r[0] for r in col(spark, ["60s", "3s", None, "PT60S", "600"], "string")
           .select(K.source_period_sec("x")).collect()]
    assert got == [60, 3, 3, 60, 60]


def test_traffic_light_and_plant(spark):
    df = spark.createDataFrame([(70.0, "A"), (69.9, "B"), (50.0, "C"), (49.9, "A"), (80.0, "D"), (None, None)],
                               "u double, z string")
    r = df.select(K.traffic_light("u", 70.0, 50.0).alias("p"), K.zone_status("z").alias("v"))
    got = [(x.p, x.v, y[0]) for x, y in zip(r.collect(), r.select(K.plant_status("p", "v")).collect())]
    assert got == [("good", "good", "good"), ("warn", "good", "warn"), ("warn", "warn", "warn"),
                   ("bad", "good", "bad"), ("good", "bad", "bad"), ("bad", "bad", "bad")]
    lower = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double").select(
        K.traffic_light("x", 1.0, 2.0, higher_is_better=False)).collect()
    assert [r[0] for r in lower] == ["good", "warn", "bad"]


def test_top_of_ties_and_zero(spark):
    df = spark.createDataFrame([(3, 3, 1), (1, 2, 2), (0, 0, 0), (0, 1, 5)], "u long, p long, e long")
    e = K.top_of({"U": F.col("u"), "P": F.col("p"), "E": F.col("e")})
    assert [r[0] for r in df.select(e).collect()] == ["U", "P", None, "E"]


def test_payload_helpers(spark):
    df = spark.createDataFrame([('{"a": 4.6, "f": "1", "n": null}',), ('{"a": -4.6, "f": "true"}',),
                                ('{"a": 4.4, "f": "0"}',), ('{bad',), ('[1,2]',)], "p string")
    parsed = F.from_json("p", "a string, f string")
    r = df.select(json_int(parsed["a"]).alias("i"), text_flag(parsed["f"]).alias("b"),
                  key_present("p", "n").alias("has_n"), key_count("p").alias("k")).collect()
    assert [x.i for x in r] == [5, -5, 4, None, None]
    assert [x.b for x in r] == [True, True, False, None, None]
    assert [x.has_n for x in r] == [True, False, False, False, False]
    assert [x.k for x in r][:4] == [3, 2, 2, None]
    assert [r[0] for r in col(spark, ["3", "F1", None], "string").select(text_int("x")).collect()] == [3, None, None]
