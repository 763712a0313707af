"""Business questions Q1–Q7 over Gold (and Silver where the plant asks).

Each function takes a ``Pipeline`` and returns a DataFrame.  Reported
doubles go through ``stable`` (6 decimals); the dashboard's own 0–3 digit
rounding is a presentation step outside these plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millstone.functions import classify as K
from millstone.functions.numeric import pct, stable
from millstone.functions.timefn import day_start, week_start
from millstone.operators.dominant import category_counts, dominant
from millstone.plans.catalog import Pipeline
from millstone.sources.refdata import MAIN_METER

ZONES_WORST_FIRST = ["D", "C", "B", "A"]
FOCUS_MOTOR = "motor_02"     # the motor the plant watches (Q2, Q7)


def q1_uptime_by_group(p: Pipeline) -> DataFrame:
    """Q1: mean hourly uptime, parts per machine and top stop reason."""
    h = p.production_hourly
    su, sp, se = F.sum("unplanned_dt_readings"), F.sum("planned_stop_readings"), F.sum("excluded_readings")
    top = (F.when((su >= sp) & (su >= se), "Unplanned Downtime")
            .when(sp >= se, "Setup / Changeover").otherwise("No Order (Excluded)"))
    return h.groupBy("machine_group", "group_number").agg(
        F.countDistinct("asset").alias("machines"),
        stable(F.avg("uptime_pct")).alias("avg_uptime_pct"),
        stable(F.sum("parts_produced") / F.countDistinct("asset")).alias("parts_per_machine"),
        top.alias("top_stop_reason"),
    )


def q1_silver_state_mix(p: Pipeline) -> DataFrame:
    """Q1 preview on Silver: state shares per work center (active machines)."""
    s = p.production_events.filter(F.col("machine_category") == "ACTIVE_PRODUCER")
    n = F.count(F.lit(1))
    cat = F.col("downtime_category")
    return s.groupBy(F.col("work_center").alias("machine_group")).agg(
        F.countDistinct("asset").alias("machine_count"),
        stable(pct(F.count_if(F.col("is_producing")), n)).alias("producing_pct"),
        stable(pct(F.count_if(cat == "PRODUCTIVE"), n)).alias("running_pct"),
        stable(pct(F.count_if(cat == "UNPLANNED_DOWNTIME"), n)).alias("unplanned_pct"),
        stable(pct(F.count_if(cat == "EXCLUDED"), n)).alias("no_order_pct"),
    )


def dash_production_summary(p: Pipeline) -> DataFrame:
    """Q1d: dashboard variant — shares are means of hourly shares."""
    h = p.production_hourly
    share = lambda c: stable(F.avg(pct(c, F.nullif(F.col("total_readings"), F.lit(0)))))
    return h.groupBy("machine_group").agg(
        F.countDistinct("asset").alias("machines"),
        stable(F.avg("uptime_pct")).alias("avg_uptime_pct"),
        F.sum("parts_produced").cast("long").alias("total_parts"),
        share("productive_readings").alias("productive_pct"),
        share("planned_stop_readings").alias("planned_stop_pct"),
        share("unplanned_dt_readings").alias("unplanned_dt_pct"),
        share("excluded_readings").alias("excluded_pct"),
    )


def q1_weighted_shares(p: Pipeline) -> DataFrame:
    """Q1w: reading-weighted shares per group."""
    h = p.production_hourly
    tot = F.sum("total_readings")
    return h.groupBy("machine_group", "group_number").agg(
        F.countDistinct("asset").alias("machines"),
        stable(F.avg("uptime_pct")).alias("avg_uptime_pct"),
        F.sum("parts_produced").cast("long").alias("total_parts"),
        stable(pct(F.sum("productive_readings"), F.sum(F.col("total_readings") - F.col("excluded_readings")))).alias("productive_pct"),
        stable(pct(F.sum("planned_stop_readings"), tot)).alias("planned_stop_pct"),
        stable(pct(F.sum("unplanned_dt_readings"), tot)).alias("unplanned_dt_pct"),
        stable(pct(F.sum("excluded_readings"), tot)).alias("excluded_pct"),
    )


def q2_zone_distribution(p: Pipeline) -> DataFrame:
    """ISO zone distribution per motor (Silver readings)."""
    v = p.vibration_events
    return v.groupBy("asset", "iso_zone").agg(
        F.count(F.lit(1)).alias("readings"),
        stable(F.avg("x_rms_velocity_mm_s")).alias("avg_rms_mm_s"),
        stable(F.max("x_rms_velocity_mm_s")).alias("max_rms_mm_s"),
    )


def q2_latest_zone(p: Pipeline, k: int = 5) -> DataFrame:
    """The latest ``k`` hours of every motor (top-k per asset; the
    window holds one asset's hourly rows, bounded by time)."""
    w = Window.partitionBy("asset").orderBy(F.col("hour_utc").desc())
    h = p.vibration_hourly.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return h.select(
        "asset", "hour_utc", F.col("dominant_iso_zone").alias("current_zone"),
        stable("avg_rms_velocity").alias("avg_rms_mm_s"), stable("max_rms_velocity").alias("max_rms_mm_s"),
        F.col("dominant_machine_state").alias("motor_state"),
    )


def q2_zone_last_7d(p: Pipeline, days: int = 7) -> DataFrame:
    """Modal zone per motor over the last ``days`` days of data.  The
    anchor is the newest reading (scalar subquery), not the wall clock."""
    v = p.vibration_events.filter(F.col("iso_zone").isNotNull())
    last = v
    if "event_date" in v.columns:
        # written tables: the hourly table knows the newest day, so both reads
        # of Silver open the partitions of a few days only
        newest = p.vibration_hourly.select(F.to_date(F.max("hour_utc"))).scalar()
        v = v.filter(F.col("event_date") >= F.date_sub(newest, days + 1))
        last = v.filter(F.col("event_date") >= newest)
    anchor = last.select(F.max("event_ts_local")).scalar()
    recent = v.filter(F.col("event_ts_local") > anchor - F.make_dt_interval(F.lit(days)))
    g = recent.groupBy("asset").agg(F.count(F.lit(1)).alias("readings"),
                                    *category_counts("iso_zone", ["A", "B", "C", "D"], "_z_"))
    return g.select("asset", dominant(ZONES_WORST_FIRST, "_z_").alias("dominant_zone"), "readings")


def q2_all_motors(p: Pipeline) -> DataFrame:
    """Q2d: every motor x dominant hourly zone."""
    return p.vibration_hourly.groupBy("asset", F.col("dominant_iso_zone").alias("dominant_zone")).agg(
        F.count(F.lit(1)).alias("hours"),
        stable(F.avg("avg_rms_velocity")).alias("overall_avg_rms"),
        stable(F.max("max_rms_velocity")).alias("peak_rms"),
        F.sum("readings_zone_d").cast("long").alias("zone_d_readings"),
    )


def dash_vibration_summary(p: Pipeline) -> DataFrame:
    """Q2e: motor summary with the arg-max zone over summed zone counts."""
    g = p.vibration_hourly.groupBy("asset").agg(
        stable(F.avg("avg_rms_velocity")).alias("avg_rms"),
        stable(F.max("max_rms_velocity")).alias("max_rms"),
        stable(F.avg("avg_rpm")).alias("avg_rpm"),
        stable(F.avg("avg_temperature_c")).alias("avg_temp_c"),
        stable(F.avg("avg_crest_factor")).alias("avg_crest"),
        *[F.sum(f"readings_zone_{z}").cast("long").alias(f"zone_{z}") for z in "abcd"],
    )
    return g.withColumn("dominant_zone", dominant(ZONES_WORST_FIRST, "zone_"))


def dash_zone_share(p: Pipeline) -> DataFrame:
    """Q2f: zone share in % per motor, long form (unpivot)."""
    s = dash_vibration_summary(p)
    long = s.unpivot(["asset"], [f"zone_{z}" for z in "abcd"], "zone_col", "readings")
    tot = Window.partitionBy("asset")  # at most 4 rows per asset
    return long.select(
        "asset", F.upper(F.substring("zone_col", 6, 1)).alias("zone"), "readings",
        stable(pct(F.col("readings"), F.sum("readings").over(tot))).alias("share_pct"),
    )


def q3a_energy_by_floor(p: Pipeline) -> DataFrame:
    """Energy and cost per sub-meter / floor (no anomaly, no main)."""
    d = p.energy_daily.filter(~F.col("is_anomaly") & (F.col("asset") != MAIN_METER))
    return d.groupBy("asset", "floor_num").agg(
        stable(F.sum("total_kwh")).alias("total_kwh"),
        stable(F.sum("total_cost_baht")).alias("total_cost_baht"),
        stable(F.sum("peak_kwh")).alias("peak_kwh"),
        stable(F.sum("offpeak_kwh")).alias("offpeak_kwh"),
        stable(F.avg("avg_power_factor")).alias("avg_pf"),
        stable(F.min("min_power_factor")).alias("min_pf"),
        F.sum("low_pf_hours").cast("long").alias("low_pf_hours"),
    )


def q3b_shift_energy(p: Pipeline) -> DataFrame:
    """Whole-plant (main meter) energy per shift label, restricted to
    days present in the daily table (semi-join: no row multiplication)."""
    h = p.energy_hourly.filter(~F.col("is_anomaly") & (F.col("asset") == MAIN_METER)) \
        .withColumn("day_local", F.to_date("hour_local"))
    days = p.energy_daily.select("asset", "day_local")
    return h.join(days, ["asset", "day_local"], "left_semi").groupBy("asset", "shift_name").agg(
        stable(F.sum("hourly_kwh")).alias("shift_kwh"),
        stable(F.avg("avg_power_factor")).alias("avg_pf"),
    )


def q4_setup_top10(p: Pipeline, k: int = 10) -> DataFrame:
    """Q4: machines with the most setup time (top-k is the feature)."""
    g = p.production_hourly.groupBy("asset", "machine_group").agg(
        (F.sum("setup_minutes") / F.lit(60.0)).alias("_hours"),
        pct(F.sum("planned_stop_readings"), F.sum(F.col("total_readings") - F.col("excluded_readings"))).alias("_pct"),
    )
    top = g.orderBy(F.col("_hours").desc(), F.col("asset").asc()).limit(k)
    return top.select("asset", "machine_group", stable("_hours").alias("total_setup_hours"),
                      stable("_pct").alias("setup_pct"))


def q5_weekly_trend(p: Pipeline) -> DataFrame:
    """Weekly RMS trend, worst dominant zone and zone-D readings."""
    h = p.vibration_hourly
    return h.groupBy("asset", week_start("hour_local").alias("week_start_local")).agg(
        stable(F.avg("avg_rms_velocity")).alias("weekly_avg_rms"),
        stable(F.avg("rolling_7day_avg_rms")).alias("rolling_7day_avg"),
        F.max("dominant_iso_zone").alias("worst_zone_in_week"),
        F.sum("readings_zone_d").cast("long").alias("zone_d_readings"),
    )


def q5_daily_trend(p: Pipeline) -> DataFrame:
    """Daily RMS with the rolling mean, every motor."""
    h = p.vibration_hourly
    return h.groupBy("asset", day_start("hour_local").alias("day_local")).agg(
        stable(F.avg("avg_rms_velocity")).alias("daily_avg_rms"),
        stable(F.avg("rolling_7day_avg_rms")).alias("rolling_7d_rms"),
        F.max("dominant_iso_zone").alias("worst_zone"),
    )


def q6_weekend_vs_weekday(p: Pipeline) -> DataFrame:
    """Q6: main-meter weekday vs weekend mean daily energy; the % gap is
    computed across both groups (same value on both rows)."""
    d = p.energy_daily.filter(F.col("asset") == MAIN_METER)
    g = d.groupBy("is_weekend").agg(
        F.countDistinct("day_local").alias("day_count"),
        F.avg("total_kwh").alias("_avg_kwh"),
        F.avg("total_cost_baht").alias("_avg_cost"),
        F.sum("total_kwh").alias("_sum_kwh"),
        F.sum("total_cost_baht").alias("_sum_cost"),
    )
    # a window over the 2-row aggregate reads the chain once (scalar
    # subqueries would re-run it per value)
    both = Window.partitionBy()
    wd = F.max(F.when(~F.col("is_weekend"), F.col("_avg_kwh"))).over(both)
    we = F.max(F.when(F.col("is_weekend"), F.col("_avg_kwh"))).over(both)
    return g.select(
        "is_weekend", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "day_count", stable("_avg_kwh").alias("avg_daily_kwh"), stable("_avg_cost").alias("avg_daily_cost_baht"),
        stable("_sum_kwh").alias("total_kwh"), stable("_sum_cost").alias("total_cost_baht"),
        stable(F.try_divide(wd - we, F.nullif(wd, F.lit(0.0))) * 100).alias("weekday_vs_weekend_pct_diff"),
    )


def dash_energy_daily_trend(p: Pipeline) -> DataFrame:
    """Daily main-meter energy and cost."""
    d = p.energy_daily.filter(F.col("asset") == MAIN_METER)
    return d.select("day_local", "floor_num", "is_weekend", stable("total_kwh").alias("total_kwh"),
                    stable("total_cost_baht").alias("cost_baht"))


def pf_alert(p: Pipeline, threshold: float = K.PF_ALERT) -> DataFrame:
    """Q6d: meters whose mean power factor is below the alert threshold."""
    d = p.energy_daily.filter(~F.col("is_anomaly"))
    g = d.groupBy("asset").agg(
        F.avg("avg_power_factor").alias("_pf"),
        F.sum("low_pf_hours").cast("long").alias("total_low_pf_hours"),
        pct(F.sum("low_pf_hours"), F.count(F.lit(1)) * 24).alias("_low_pct"),
    ).filter(F.col("_pf") < threshold)
    return g.select("asset", stable("_pf").alias("overall_avg_pf"), "total_low_pf_hours",
                    stable("_low_pct").alias("low_pf_pct_of_time"))


def plant_health(p: Pipeline) -> DataFrame:
    """Q7: one-row plant status.  Both inputs are aggregates evaluated as
    scalar subqueries; nothing is collected to the driver."""
    prod = dash_production_summary(p)
    # one subquery per input chain (a struct carries both production values)
    prod_stats = prod.select(F.struct(F.avg("avg_uptime_pct").alias("u"), F.count(F.lit(1)).alias("n"))).scalar()
    avg_uptime, n_groups = prod_stats.getField("u"), prod_stats.getField("n")
    vib = dash_vibration_summary(p).filter(F.col("asset") == FOCUS_MOTOR)
    zone = vib.select(F.max("dominant_zone")).scalar()
    row = p.spark.range(1).select(
        stable(avg_uptime).alias("avg_uptime_pct"), n_groups.alias("machine_groups"),
        F.coalesce(zone, F.lit("?")).alias("motor02_zone"),
    )
    row = row.select(
        "*",
        F.when(F.col("machine_groups") > 0, K.traffic_light("avg_uptime_pct", K.UPTIME_GOOD, K.UPTIME_WARN))
         .otherwise("bad").alias("prod_status"),
        K.zone_status("motor02_zone").alias("vib_status"),
        (F.col("motor02_zone") == "D").alias("zone_d_alert"),
    )
    status = K.plant_status("prod_status", "vib_status")
    return row.select("*", status.alias("plant_status"))


def dash_downtime_long(p: Pipeline) -> DataFrame:
    """Q7l: downtime shares wide -> long (unpivot)."""
    s = dash_production_summary(p)
    cols = ["productive_pct", "planned_stop_pct", "unplanned_dt_pct", "excluded_pct"]
    return s.unpivot(["machine_group"], cols, "category", "pct")
