"""Capabilities the plant's brief asks for beyond the delivered SQL
(X1–X10), plus the designed-but-unused range lookups (J6, J7) and the
time-range rolling mean (W8).  Thresholds marked 'ours' are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstone.functions import classify as K
from millstone.functions.numeric import stable
from millstone.functions.timefn import day_of, epoch_micros, minute_of_day
from millstone.operators.islands import hour_segments, state_runs, stitch_segments
from millstone.plans.catalog import Pipeline
from millstone.sources import refdata
from millstone.sources.refdata import ANOMALOUS_METER, MAIN_METER

TREND_SLOPE = 0.05        # mm/s per day — ours
ANOMALY_Z = 3.0           # |z| above which an hourly RMS is anomalous — ours
ANOMALY_WINDOW = 168      # preceding hourly rows used as the baseline — ours
CREST_ALARM, KURTOSIS_ALARM = 6.0, 5.0


def zone_alerts(vibration_hourly: DataFrame) -> DataFrame:
    zone = F.col("dominant_iso_zone")
    return vibration_hourly.filter(zone.isin("C", "D")).select(
        F.concat(F.lit("VIBRATION_ZONE_"), zone).alias("rule"), "asset", "hour_utc",
        F.col("avg_rms_velocity").alias("value"), F.when(zone == "D", "bad").otherwise("warn").alias("severity"))


def _low(hourly: DataFrame, value: str, below: float, rule: str, severity: str) -> DataFrame:
    least = hourly.groupBy("asset", "hour_utc").agg(F.min(value).alias("value")).filter(F.col("value") < below)
    return least.select(F.lit(rule).alias("rule"), "asset", "hour_utc", "value", F.lit(severity).alias("severity"))


def uptime_alerts(production_hourly: DataFrame) -> DataFrame:
    return _low(production_hourly, "uptime_pct", K.UPTIME_WARN, "LOW_UPTIME", "bad")


def power_factor_alerts(energy_hourly: DataFrame) -> DataFrame:
    return _low(energy_hourly, "min_power_factor", K.LOW_PF, "LOW_PF", "warn")


def reported_alerts(a: DataFrame) -> DataFrame:
    return a.select("rule", "asset", "hour_utc", stable("value").alias("value"), "severity")


def alerts(p: Pipeline) -> DataFrame:
    """Alert history — zone C/D hours, hourly uptime < 50 %, PF < 0.85;
    one row per (rule, asset, hour)."""
    return reported_alerts(zone_alerts(p.vibration_hourly).unionByName(uptime_alerts(p.production_hourly))
                           .unionByName(power_factor_alerts(p.energy_hourly)))


def _daily_rms(p: Pipeline) -> DataFrame:
    return p.vibration_hourly.groupBy("asset", day_of("hour_local").alias("day_local")).agg(
        F.avg("avg_rms_velocity").alias("daily_avg_rms"))


def trend_direction(p: Pipeline, threshold: float = TREND_SLOPE) -> DataFrame:
    """Least-squares slope per motor of the 7-day rolling mean RMS, taken
    once a day (the mean of its hourly values)."""
    d = p.vibration_hourly.groupBy("asset", day_of("hour_local").alias("day_local")).agg(
        F.avg("rolling_7day_avg_rms").alias("y"))
    d = d.withColumn("x", F.datediff("day_local", F.lit("1970-01-01").cast("date")).cast("double"))
    g = d.groupBy("asset").agg(F.count(F.lit(1)).alias("days"), F.regr_slope("y", "x").alias("_slope"))
    return g.select("asset", "days", stable("_slope").alias("slope_mm_s_per_day"),
                    F.when(F.col("_slope") > threshold, "degrading").when(F.col("_slope") < -threshold, "improving")
                     .otherwise("stable").alias("direction"))


def rms_anomalies(p: Pipeline, z: float = ANOMALY_Z, window: int = ANOMALY_WINDOW) -> DataFrame:
    """Hourly RMS far from its trailing baseline (z-score)."""
    w = Window.partitionBy("asset").orderBy("hour_utc").rowsBetween(-window, -1)
    h = p.vibration_hourly.select("asset", "hour_utc", "avg_rms_velocity",
                                  F.avg("avg_rms_velocity").over(w).alias("_mean"),
                                  F.stddev_samp("avg_rms_velocity").over(w).alias("_sd"))
    h = h.withColumn("_z", F.try_divide(F.col("avg_rms_velocity") - F.col("_mean"), F.nullif("_sd", F.lit(0.0))))
    return h.filter(F.abs("_z") > z).select("asset", "hour_utc", stable("avg_rms_velocity").alias("avg_rms"),
                                            stable("_mean").alias("baseline_rms"), stable("_z").alias("z_score"))


def _rms_line(p: Pipeline) -> tuple[DataFrame, Column]:
    """Per motor the least-squares line of hourly RMS over days, and the
    line's value at the motor's newest hour."""
    h = p.vibration_hourly.withColumn("x", epoch_micros("hour_utc") / F.lit(86400000000.0))
    g = h.groupBy("asset").agg(F.regr_slope("avg_rms_velocity", "x").alias("_slope"),
                               F.regr_avgx("avg_rms_velocity", "x").alias("_ax"),
                               F.regr_avgy("avg_rms_velocity", "x").alias("_ay"),
                               F.max("x").alias("_last"))
    now = F.col("_ay") + F.col("_slope") * (F.col("_last") - F.col("_ax"))
    return g, now


def rms_forecast_7d(p: Pipeline, days: int = 7) -> DataFrame:
    """The line carried on, one row per motor and day ahead."""
    g, now = _rms_line(p)
    g = g.select("asset", "_slope", now.alias("_now"), F.explode(F.sequence(F.lit(1), F.lit(days))).alias("days_ahead"))
    rms = F.col("_now") + F.col("_slope") * F.col("days_ahead")
    return g.select("asset", "days_ahead", stable(rms).alias("forecast_rms"), K.iso_zone(rms).alias("forecast_zone"))


def days_to_zone_d(p: Pipeline) -> DataFrame:
    """Days until the fitted line reaches the zone-D bound (NULL when flat
    or falling)."""
    g, now = _rms_line(p)
    d = F.when(now >= K.ZONE_BOUNDS[2], F.lit(0.0)).when(F.col("_slope") > 0,
                                                          (F.lit(K.ZONE_BOUNDS[2]) - now) / F.col("_slope"))
    return g.select("asset", stable("_slope").alias("slope_per_day"), stable(now).alias("fitted_rms_now"),
                    stable(d, 3).alias("days_to_zone_d"))


def ap_score(p: Pipeline) -> DataFrame:
    """Availability x performance per machine (active machines).
    availability = productive / non-excluded readings; performance = ideal
    cycle time x parts / productive seconds."""
    s = p.production_events.filter(F.col("machine_category") == "ACTIVE_PRODUCER")
    prod = F.col("downtime_category") == "PRODUCTIVE"
    g = s.groupBy("asset").agg(
        F.count_if(prod).alias("_p"), F.count_if(F.col("downtime_category") != "EXCLUDED").alias("_a"),
        F.sum(F.when(prod, F.coalesce("parts_delta", F.lit(0)) * F.col("wo_cycle_time_sec"))).alias("_ideal"),
        F.sum(F.when(prod, F.col("source_period_sec"))).alias("_secs"))
    av = F.try_divide(F.col("_p").cast("double"), F.nullif(F.col("_a"), F.lit(0)).cast("double"))
    pf = F.try_divide(F.col("_ideal"), F.nullif(F.col("_secs"), F.lit(0)).cast("double"))
    return g.select("asset", stable(av).alias("availability"), stable(pf).alias("performance"),
                    stable(av * pf).alias("ap_score"))


PERIOD = "source_period_sec"
IN_SETUP = "downtime_category = 'PLANNED_STOP'"


def _active(production_events: DataFrame) -> DataFrame:
    return production_events.filter(F.col("machine_category") == "ACTIVE_PRODUCER") \
        .select("asset", "event_ts", "downtime_category", PERIOD)


def _reported_runs(r: DataFrame) -> DataFrame:
    return r.select("asset", "run_start", "run_end", "readings",
                    stable(F.col(f"{PERIOD}_sum") / F.lit(60.0)).alias("setup_minutes"))


def setup_runs(p: Pipeline) -> DataFrame:
    """X6/ST10: consecutive PLANNED_STOP readings per machine as runs."""
    return _reported_runs(state_runs(_active(p.production_events), "asset", "event_ts", F.expr(IN_SETUP), weight=PERIOD))


def setup_segments(production_events: DataFrame) -> DataFrame:
    """ST10: the runs cut at the hour, as the Gold stream stores them."""
    return hour_segments(_active(production_events), "asset", "event_ts", F.expr(IN_SETUP), PERIOD)


def setup_runs_of(segments: DataFrame) -> DataFrame:
    """``setup_runs`` from stored segments."""
    return _reported_runs(stitch_segments(segments, "asset", PERIOD))


def downtime_by_reason(p: Pipeline) -> DataFrame:
    """Readings per machine group and reason name via the status
    code lookup (NULL status -> its own 'no data' row), ranked."""
    s = p.production_events.filter(F.col("machine_category") == "ACTIVE_PRODUCER")
    rc = F.broadcast(p.reason_codes.select(F.col("status_code").alias("_sc"), "reason_name",
                                           F.col("downtime_category").alias("_cat"), "is_countable_dt"))
    j = s.join(rc, s["status_code"].eqNullSafe(rc["_sc"]), "left")
    g = j.groupBy(F.col("work_center").alias("machine_group"), F.coalesce("reason_name", F.lit("Unmapped")).alias("reason_name"),
                  "downtime_category").agg(F.count(F.lit(1)).alias("readings"),
                                           F.coalesce(F.max("is_countable_dt"), F.lit(False)).alias("is_countable_dt"))
    w = Window.partitionBy("machine_group").orderBy(F.col("readings").desc(), F.col("reason_name"))
    return g.withColumn("rank_in_group", F.row_number().over(w).cast("long"))


def energy_by_shift_floor(p: Pipeline) -> DataFrame:
    """Exact shift split of floor energy (spread per meter, hour and
    shift from Silver), excluding the main board and the anomalous meter."""
    s = p.power_events.filter((F.col("asset") != MAIN_METER) & (F.col("asset") != ANOMALOUS_METER))
    from millstone.functions.timefn import hour_start
    h = s.groupBy("asset", "floor_num", hour_start("event_ts_local").alias("hour_local"), "shift_name").agg(
        (F.max("energy_kwh_cumul") - F.min("energy_kwh_cumul")).alias("_kwh"))
    g = h.groupBy("floor_num", "shift_name").agg(F.sum("_kwh").alias("_k"), F.countDistinct("asset").alias("meters"))
    return g.select("floor_num", "shift_name", stable("_k").alias("kwh"), "meters")


def bearing_flags(p: Pipeline) -> DataFrame:
    """Crest factor > 6 / kurtosis > 5 readings per motor and day."""
    v = p.vibration_events
    return v.groupBy("asset", day_of("event_ts_local").alias("day_local")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("x_crest_factor") > CREST_ALARM).alias("crest_alarms"),
        F.count_if(F.col("x_kurtosis") > KURTOSIS_ALARM).alias("kurtosis_alarms"),
        F.count_if((F.col("x_crest_factor") > CREST_ALARM) & (F.col("x_kurtosis") > KURTOSIS_ALARM)).alias("both_alarms"))


def pf_by_floor_hour(p: Pipeline) -> DataFrame:
    """Power factor by floor and local hour of day."""
    e = p.energy_hourly.filter(~F.col("is_anomaly"))
    return e.groupBy("floor_num", F.hour("hour_local").alias("hour_of_day")).agg(
        stable(F.avg("avg_power_factor")).alias("avg_pf"), stable(F.min("min_power_factor")).alias("min_pf"),
        F.count_if(F.col("low_pf_flag")).alias("low_pf_hours"))


def shift_range_join(p: Pipeline) -> DataFrame:
    """Time -> shift as an equi-join on minute of day against the
    1,440-row calendar (broadcast; fixed size)."""
    cal = F.broadcast(refdata.minute_calendar(p.spark))
    s = p.production_events.select("asset", "downtime_category", minute_of_day("event_ts_local").alias("minute_of_day"))
    j = s.join(cal, "minute_of_day", "left")
    return j.groupBy("shift_name", "downtime_category").agg(F.count(F.lit(1)).alias("readings"))


def tariff_range_join(p: Pipeline) -> DataFrame:
    """Meter-hour -> tariff band as an equi-join on (ISO day, hour)
    against the 168-row hour-of-week table; cost per band."""
    how = F.broadcast(refdata.hour_of_week(p.spark))
    e = p.energy_hourly.select("asset", "hourly_kwh", "day_of_week", F.hour("hour_local").alias("hour_local"))
    j = e.join(how, ["day_of_week", "hour_local"], "left")
    g = j.groupBy("asset", "period_name", "is_peak").agg(
        F.sum("hourly_kwh").alias("_kwh"), F.sum(F.col("hourly_kwh") * F.col("rate_baht_per_kwh")).alias("_cost"),
        F.count(F.lit(1)).alias("hours"))
    return g.select("asset", "period_name", "is_peak", "hours", stable("_kwh").alias("kwh"), stable("_cost").alias("cost_baht"))


def rolling_7_days(p: Pipeline) -> DataFrame:
    """7-day time-range rolling mean beside the 168-row version."""
    return p.vibration_hourly.select("asset", "hour_utc", stable("rolling_7day_avg_rms").alias("rolling_168_rows"),
                                     stable("rolling_7d_time_avg_rms").alias("rolling_7_days"))



