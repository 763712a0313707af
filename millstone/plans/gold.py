"""Gold: hourly / daily KPI tables.

Every Gold build is ONE aggregation with map-side partial aggregation: a
machine or meter that sends a third of all messages is folded into at most
one row per hour per map task before the exchange.  Reference tables are
fixed-size and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstone.functions import classify as K
from millstone.functions.timefn import day_of, hour_start
from millstone.operators.dominant import category_counts, dominant
from millstone.operators.rolling import rolling_rows, rolling_time
from millstone.sources.refdata import OFFPEAK_RATE, PEAK_RATE

ZONES = ["A", "B", "C", "D"]
STATES = ["IDLE", "OFFLINE", "RUNNING", "STARTING_STOPPING"]
SHIFT_NAMES = ["Day", "Day OT", "Night", "Night OT"]


def production_hourly(silver_production: DataFrame, machine_config: DataFrame) -> DataFrame:
    """D5.  Grain (asset, hour_utc, shift_name): hours that straddle a shift
    change produce one row per shift."""
    cat = F.col("downtime_category")
    base = silver_production.filter(F.col("machine_category") == "ACTIVE_PRODUCER").select(
        hour_start("event_ts").alias("hour_utc"), hour_start("event_ts_local").alias("hour_local"),
        "asset", K.shift_name("event_ts_local").alias("shift_name"), "downtime_category",
        F.coalesce("parts_delta", F.lit(0)).alias("parts_delta"),
        F.coalesce("source_period_sec", F.lit(3)).alias("period_sec"), "wo_cycle_time_sec",
    )
    agg = base.groupBy("hour_utc", "hour_local", "asset", "shift_name").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(cat == "PRODUCTIVE").alias("productive_readings"),
        F.count_if(cat == "PLANNED_STOP").alias("planned_stop_readings"),
        F.count_if(cat == "UNPLANNED_DOWNTIME").alias("unplanned_dt_readings"),
        F.count_if(cat == "EXCLUDED").alias("excluded_readings"),
        F.count_if(cat == "UNKNOWN").alias("unknown_readings"),
        F.sum("parts_delta").cast("long").alias("parts_produced"),
        (F.sum(F.when(cat == "PLANNED_STOP", F.col("period_sec")).otherwise(0)) / F.lit(60.0)).alias("setup_minutes"),
        F.avg(F.when(cat == "PRODUCTIVE", F.col("wo_cycle_time_sec"))).alias("avg_cycle_time_sec"),
    )
    mc = F.broadcast(machine_config.select("asset", "machine_group", "group_number"))
    j = agg.join(mc, "asset", "inner")
    available = F.col("total_readings") - F.col("excluded_readings")
    return j.select(
        "hour_utc", "hour_local", "asset", "machine_group", "group_number", "shift_name",
        "total_readings", "productive_readings", "planned_stop_readings", "unplanned_dt_readings",
        "excluded_readings", "unknown_readings", available.alias("available_readings"),
        F.when(available == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(100.0) * F.col("productive_readings") / available).alias("uptime_pct"),
        "parts_produced", "setup_minutes", "avg_cycle_time_sec",
        K.top_of({"UNPLANNED_DOWNTIME": F.col("unplanned_dt_readings"),
                  "PLANNED_STOP": F.col("planned_stop_readings"),
                  "EXCLUDED": F.col("excluded_readings")}).alias("top_stop_category"),
    )


def vibration_hourly(silver_vibration: DataFrame) -> DataFrame:
    """D6 in a single scan.  Metrics cover readings with an RMS value; the
    dominant machine state counts every reading (a state is valid without
    RMS).  Ties: dominant zone -> the worse zone, dominant state ->
    alphabetical first."""
    v = silver_vibration.filter(~F.col("is_quarantined"))
    has_rms = F.col("x_rms_velocity_mm_s").isNotNull()
    when_rms = lambda c: F.when(has_rms, F.col(c))
    g = v.groupBy(hour_start("event_ts").alias("hour_utc"), hour_start("event_ts_local").alias("hour_local"), "asset").agg(
        F.count_if(has_rms).alias("reading_count"),
        F.avg("x_rms_velocity_mm_s").alias("avg_rms_velocity"),
        F.max("x_rms_velocity_mm_s").alias("max_rms_velocity"),
        *category_counts("iso_zone", ZONES, "readings_zone_"),
        F.avg(when_rms("rotational_speed_rpm")).alias("avg_rpm"),
        *category_counts("machine_state", STATES, "_st_all_"),
        F.count_if(has_rms & (F.col("machine_state") == "RUNNING")).alias("readings_running"),
        F.count_if(has_rms & (F.col("machine_state") == "IDLE")).alias("readings_idle"),
        F.count_if(has_rms & (F.col("machine_state") == "OFFLINE")).alias("readings_offline"),
        F.avg(when_rms("temperature_c")).alias("avg_temperature_c"),
        F.avg(when_rms("x_crest_factor")).alias("avg_crest_factor"),
        F.max(when_rms("x_crest_factor")).alias("max_crest_factor"),
        F.avg(when_rms("x_kurtosis")).alias("avg_kurtosis"),
    ).filter(F.col("reading_count") > 0)
    out = g.select(
        "hour_utc", "hour_local", "asset", "reading_count", "avg_rms_velocity", "max_rms_velocity",
        dominant(list(reversed(ZONES)), "readings_zone_").alias("dominant_iso_zone"),
        *[f"readings_zone_{z.lower()}" for z in ZONES], "avg_rpm",
        dominant(STATES, "_st_all_").alias("dominant_machine_state"),
        "readings_running", "readings_idle", "readings_offline",
        "avg_temperature_c", "avg_crest_factor", "max_crest_factor", "avg_kurtosis",
    )
    return out.withColumn("rolling_7day_avg_rms", rolling_rows("avg_rms_velocity")) \
              .withColumn("rolling_7d_time_avg_rms", rolling_time("avg_rms_velocity"))


def energy_hourly(silver_power: DataFrame) -> DataFrame:
    """D7.  Counter spread MAX−MIN per meter-hour; NULL spreads dropped."""
    kwh, kvarh = F.col("energy_kwh_cumul"), F.col("energy_kvarh_cumul")
    g = silver_power.groupBy(
        "asset", "floor_num", hour_start("event_ts_local").alias("hour_local"),
        hour_start("event_ts").alias("hour_utc"),
    ).agg(
        (F.max(kwh) - F.min(kwh)).alias("hourly_kwh"),
        (F.max(kvarh) - F.min(kvarh)).alias("hourly_kvarh"),
        F.avg("active_power_kw").alias("avg_active_power_kw"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.min("power_factor").alias("min_power_factor"),
        F.bool_or("is_peak_hour").alias("is_peak_hour"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.max("shift_name").alias("shift_name"),
        F.max("day_of_week").alias("day_of_week"),
        F.bool_or("is_anomaly").alias("is_anomaly"),
    ).filter(F.col("hourly_kwh") >= 0)
    rate = F.when(F.col("is_peak_hour"), F.lit(PEAK_RATE)).otherwise(F.lit(OFFPEAK_RATE))
    return g.select(
        "asset", "floor_num", "hour_local", "hour_utc", "hourly_kwh", "hourly_kvarh",
        "avg_active_power_kw", "avg_power_factor", "min_power_factor",
        (F.col("min_power_factor") < K.LOW_PF).alias("low_pf_flag"),
        "is_peak_hour", "is_weekend", "shift_name", "day_of_week",
        (F.col("hourly_kwh") * rate).alias("energy_cost_baht"), "is_anomaly",
    )


def energy_daily(energy_hourly_df: DataFrame) -> DataFrame:
    """Roll-up of D7 per meter and local day."""
    kwh, peak = F.col("hourly_kwh"), F.col("is_peak_hour")
    peak_cost = F.sum(F.when(peak, kwh * F.lit(PEAK_RATE)).otherwise(0.0))
    off_cost = F.sum(F.when(~peak, kwh * F.lit(OFFPEAK_RATE)).otherwise(0.0))
    g = energy_hourly_df.groupBy("asset", "floor_num", day_of("hour_local").alias("day_local")).agg(
        F.sum(kwh).alias("total_kwh"),
        F.sum(F.when(peak, kwh).otherwise(0.0)).alias("peak_kwh"),
        F.sum(F.when(~peak, kwh).otherwise(0.0)).alias("offpeak_kwh"),
        peak_cost.alias("peak_cost_baht"), off_cost.alias("offpeak_cost_baht"),
        F.avg("avg_power_factor").alias("avg_power_factor"),
        F.min("min_power_factor").alias("min_power_factor"),
        F.sum(F.col("low_pf_flag").cast("int")).cast("int").alias("low_pf_hours"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.max("day_of_week").alias("day_of_week"),
        *[F.sum(F.when(F.col("shift_name") == s, kwh).otherwise(0.0)).alias(f"_shift_{i}")
          for i, s in enumerate(SHIFT_NAMES)],
        F.bool_or("is_anomaly").alias("is_anomaly"),
    )
    breakdown = F.create_map(*[x for i, s in enumerate(SHIFT_NAMES) for x in (F.lit(s), F.col(f"_shift_{i}"))])
    return g.select(
        "asset", "floor_num", "day_local", "total_kwh", "peak_kwh", "offpeak_kwh",
        (F.col("peak_cost_baht") + F.col("offpeak_cost_baht")).alias("total_cost_baht"),
        "peak_cost_baht", "offpeak_cost_baht", "avg_power_factor", "min_power_factor",
        "low_pf_hours", "is_weekend", "day_of_week", breakdown.alias("shift_breakdown"),
        *[F.col(f"_shift_{i}").alias(f"kwh_{s.lower().replace(' ', '_')}") for i, s in enumerate(SHIFT_NAMES)],
        "is_anomaly",
    )
