"""Reference tables and time helpers."""

from datetime import datetime

from pyspark.sql import functions as F

from millstone.functions.timefn import day_start, epoch_micros, event_id, hour_start, iso_dow, to_local, week_start
from millstone.sources import refdata


def test_machine_config_groups(spark):
    mc = refdata.machine_config(spark)
    counts = {r.machine_group: (r.n, r.ar) for r in mc.groupBy("machine_group").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_always_running").alias("ar")).collect()}
    assert counts == {"Group1": (13, 0), "Group2": (11, 2), "Group3": (6, 1), "Group4": (8, 0)}
    assert mc.select("asset").distinct().count() == 38


def test_reason_codes_has_null_row(spark):
    rc = refdata.reason_codes(spark)
    assert rc.count() == 10
    assert rc.filter(F.col("status_code").isNull()).first().reason_name == "Offline / No Data"


def test_minute_calendar_covers_day_once(spark):
    cal = refdata.minute_calendar(spark)
    assert cal.count() == 1440
    assert cal.select("minute_of_day").distinct().count() == 1440
    per = {r.shift_name: r.n for r in cal.groupBy("shift_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"Day": 540, "Day OT": 180, "Night": 540, "Night OT": 180}


def test_tariff_covers_week_once(spark):
    how = refdata.hour_of_week(spark)
    assert how.count() == 168
    assert how.filter(F.col("rate_baht_per_kwh").isNull()).count() == 0
    assert how.groupBy("day_of_week", "hour_local").count().filter("count > 1").count() == 0
    peak = how.filter("is_peak").count()
    assert peak == 5 * 13


def test_time_helpers_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        t = datetime(2024, 3, 10, 2, 30, 0, 123456)   # inside a US DST gap
        df = spark.createDataFrame([(t, "FM11", "0.1")], "t timestamp_ntz, a string, v string")
        r = df.select(hour_start("t").alias("h"), day_start("t").alias("d"), week_start("t").alias("w"),
                      iso_dow("t").alias("dow"), to_local("t").alias("loc"), epoch_micros("t").alias("us"),
                      event_id("a", "t", "v").alias("id")).first()
        assert r.h == datetime(2024, 3, 10, 2, 0)
        assert r.d == datetime(2024, 3, 10)
        assert r.w == datetime(2024, 3, 4)
        assert r.dow == 7
        assert r.loc == datetime(2024, 3, 10, 9, 30, 0, 123456)
        assert r.us == int((t - datetime(1970, 1, 1)).total_seconds()) * 1000000 + 123456
        assert r.id == "FM11|2024-03-10 02:30:00.123456|0.1"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
