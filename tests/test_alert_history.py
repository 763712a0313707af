"""Alert history appended by refreshes; setup runs stitched from hourly segments."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millstone.operators.islands import hour_segments, state_runs, stitch_segments
from millstone.streaming.alert_history import alert_history, append_alerts, standing

H0, H1 = datetime(2024, 5, 1, 23), datetime(2024, 5, 2, 0)
HOURLY = "asset string, hour_utc timestamp_ntz, uptime_pct double"


def _refresh(spark, tables, refresh_id, rows):
    """Gold holds ``rows``; the refresh touched their hours (and those of m9)."""
    g = spark.createDataFrame(rows, HOURLY)
    g.withColumn("hour_date", F.to_date("hour_utc")).write.mode("overwrite").parquet(f"{tables}/production_hourly")
    touched = g.select("asset", "hour_utc").union(spark.createDataFrame([("m9", H0)], "asset string, hour_utc timestamp_ntz"))
    append_alerts(spark, tables, "production", touched.distinct(), [H0.date(), H1.date()], refresh_id)


def _standing(spark, tables):
    return sorted(((r.asset or "", r.hour_utc, r.value) for r in standing(alert_history(spark, tables)).collect()))


def test_a_refresh_appends_what_it_changed_and_its_replay_nothing(spark, scratch):
    t = f"{scratch}/tables"
    assert alert_history(spark, t).count() == 0
    _refresh(spark, t, 0, [("m1", H0, 10.0), ("m1", H1, 20.0), (None, H0, 5.0), ("m2", H0, 90.0), ("m9", H0, 1.0)])
    assert _standing(spark, t) == [("", H0, 5.0), ("m1", H0, 10.0), ("m1", H1, 20.0), ("m9", H0, 1.0)]
    second = [("m1", H0, 10.0), ("m1", H1, 30.0), (None, H0, 80.0), ("m2", H0, 40.0), ("m2", H0, None)]
    for _ in range(2):                                                  # the refresh and its replay
        _refresh(spark, t, 1, second)
        new = alert_history(spark, t).filter("refresh_id = 1")
        assert sorted((r.asset or "", r.hour_utc, r.action) for r in new.collect()) == [
            ("", H0, "cleared"), ("m1", H1, "changed"), ("m2", H0, "raised"), ("m9", H0, "cleared")]
        assert _standing(spark, t) == [("m1", H0, 10.0), ("m1", H1, 30.0), ("m2", H0, 40.0)]
    _refresh(spark, t, 2, second)                                       # nothing changed: no rows
    assert alert_history(spark, t).filter("refresh_id = 2").count() == 0
    _refresh(spark, t, 3, [("m9", H0, 2.0)])                            # a cleared alert comes back
    assert ("m9", H0, 2.0) in _standing(spark, t)
    assert alert_history(spark, t).filter("refresh_id = 3").first().action == "raised"


def _runs(df):
    cols = ["asset", "run_start", "run_end", "readings", "sec_sum"]
    return sorted(df.select(*cols).collect(), key=lambda r: (r.asset or "", r.run_start))


def test_runs_are_the_same_cut_at_hours_and_stitched(spark):
    rnd = random.Random(11)
    rows = []
    for asset in ("a", "b", "c", None):
        at = datetime(2024, 1, 1)
        for _ in range(150):
            at += timedelta(minutes=rnd.choice([1, 7, 20, 59, 60, 61, 200]))     # hours without readings too
            rows.append((asset, at, rnd.choice([True, True, False, None]) if asset != "c" else True, rnd.choice([3, 60])))
    df = spark.createDataFrame(rows, "asset string, ts timestamp_ntz, s boolean, sec int")
    expected = []
    for asset in ("a", "b", "c", None):
        run = []
        for r in [*sorted((x for x in rows if x[0] == asset), key=lambda x: x[1]), (asset, None, False, 0)]:
            if r[2]:
                run.append(r)
            elif run:
                expected.append((asset, run[0][1], run[-1][1], len(run), sum(x[3] for x in run)))
                run = []
    expected.sort(key=lambda r: (r[0] or "", r[1]))
    seg = hour_segments(df, "asset", "ts", F.col("s"), "sec")
    assert [tuple(r) for r in _runs(stitch_segments(seg, "asset", "sec"))] == expected
    assert [tuple(r) for r in _runs(state_runs(df, "asset", "ts", F.col("s"), "sec"))] == expected
    # an hour's rows depend on that hour alone: replacing it by itself changes nothing
    hour = seg.filter("in_run").first().hour_utc
    one = hour_segments(df.filter(F.date_trunc("hour", "ts") == F.lit(str(hour)).cast("timestamp_ntz")), "asset", "ts", F.col("s"), "sec")
    assert sorted(map(str, one.collect())) == sorted(map(str, seg.filter(F.col("hour_utc") == one.first().hour_utc).collect()))
    assert stitch_segments(seg.limit(0), "asset", "sec").count() == 0
