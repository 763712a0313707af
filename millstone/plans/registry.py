"""Name -> query plan.  Every plan reads the input folder (``events``) and
derives everything else from it with Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.functions.numeric import stable
from millstone.plans import business as B
from millstone.plans import extensions as X
from millstone.plans import incremental as M
from millstone.plans import ingest as I
from millstone.plans import payload_rules as J
from millstone.plans import profiling as V
from millstone.plans.catalog import Pipeline


AUDIT_COLS = ("loaded_at", "event_date", "event_hour", "hour_date", "day_part")


def _stable_doubles(df: DataFrame, drop=()) -> DataFrame:
    drop = set(drop) | set(AUDIT_COLS)
    return df.select(*[stable(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields if f.name not in drop])


def _silver_production(p):
    return _stable_doubles(p.production_events)


def _silver_vibration(p):
    return _stable_doubles(p.vibration_events)


def _silver_quarantine(p):
    return _stable_doubles(p.vibration_quarantine)


def _silver_power(p):
    return _stable_doubles(p.power_events)


def _production_hourly(p):
    return _stable_doubles(p.production_hourly)


def _vibration_hourly(p):
    return _stable_doubles(p.vibration_hourly, drop=("rolling_7d_time_avg_rms",))


def _energy_hourly(p):
    return _stable_doubles(p.energy_hourly)


def _energy_daily(p):
    return _stable_doubles(p.energy_daily, drop=("shift_breakdown",))


def _energy_daily_shift_breakdown(p):
    """The per-shift kWh map of the daily table, one row per entry."""
    d = p.energy_daily.select("asset", "floor_num", "day_local",
                              F.explode("shift_breakdown").alias("shift_name", "kwh"))
    return d.select("asset", "floor_num", "day_local", "shift_name", stable("kwh").alias("kwh"))


PLANS: dict[str, Callable[[Pipeline], DataFrame]] = {
    # silver / gold tables
    "silver_production": _silver_production,
    "silver_vibration": _silver_vibration,
    "silver_vibration_quarantine": _silver_quarantine,
    "silver_power": _silver_power,
    "production_hourly": _production_hourly,
    "vibration_hourly": _vibration_hourly,
    "energy_hourly": _energy_hourly,
    "energy_daily": _energy_daily,
    "energy_daily_shift_breakdown": _energy_daily_shift_breakdown,
    # load path
    "bronze_load": I.bronze_load,
    "bronze_file_manifest": I.bronze_file_manifest,
    "bronze_by_domain": V.bronze_by_domain,
    "bronze_union_domains": I.bronze_union_domains,
    # payload rules
    "json_typed_extract": J.json_typed_extract,
    "json_invalid_routing": J.json_invalid_routing,
    # predicates
    "filter_three_valued": V.filter_three_valued,
    "like_ilike": V.like_ilike,
    # incremental semantics: dedup, keyed merges, high-water mark
    "dedup_production": M.dedup_production,
    "dedup_vibration": M.dedup_vibration,
    "dedup_power": M.dedup_power,
    "merge_insert_only": lambda p: _stable_doubles(M.merge_insert_only(p)),
    "merge_upsert": lambda p: _stable_doubles(M.merge_upsert(p)),
    "watermark_filter": M.watermark_filter,
    # mode per hour
    "dominant_zone_hourly": V.dominant_zone_hourly,
    "dominant_state_hourly": V.dominant_state_hourly,
    "gold_refresh_incremental": lambda p: _stable_doubles(M.gold_refresh_incremental(p)),
    # business questions
    "q1_uptime_by_group": B.q1_uptime_by_group,
    "q1_silver_state_mix": B.q1_silver_state_mix,
    "dash_production_summary": B.dash_production_summary,
    "q1_weighted_shares": B.q1_weighted_shares,
    "q2_zone_distribution": B.q2_zone_distribution,
    "q2_latest_zone": B.q2_latest_zone,
    "q2_zone_last_7d": B.q2_zone_last_7d,
    "q2_all_motors": B.q2_all_motors,
    "dash_vibration_summary": B.dash_vibration_summary,
    "dash_zone_share": B.dash_zone_share,
    "q3a_energy_by_floor": B.q3a_energy_by_floor,
    "q3b_shift_energy": B.q3b_shift_energy,
    "q4_setup_top10": B.q4_setup_top10,
    "q5_weekly_trend": B.q5_weekly_trend,
    "q5_daily_trend": B.q5_daily_trend,
    "q6_weekend_vs_weekday": B.q6_weekend_vs_weekday,
    "dash_energy_daily_trend": B.dash_energy_daily_trend,
    "pf_alert": B.pf_alert,
    "plant_health": B.plant_health,
    "dash_downtime_long": B.dash_downtime_long,
    # profiling / data quality
    "profile_by_version": V.profile_by_version,
    "profile_payload_keys": V.profile_payload_keys,
    "json_key_count": V.json_key_count,
    "payload_types": V.payload_types,
    "profile_state_codes": V.profile_state_codes,
    "profile_quality": V.profile_quality,
    "duplicate_keys": V.duplicate_keys,
    "assert_unique_event_id": V.assert_unique_event_id,
    "counter_resets": V.counter_resets,
    "profile_hierarchy": V.profile_hierarchy,
    "quarantine_breakdown": V.quarantine_breakdown,
    "power_row_audit": V.power_row_audit,
    "peak_hour_audit": V.peak_hour_audit,
    "energy_counter_range": V.energy_counter_range,
    "row_count_audit": V.row_count_audit,
    "kw_by_weekday": V.kw_by_weekday,
    "coverage_gaps": V.coverage_gaps,
    "meter_reconciliation": V.meter_reconciliation,
    "vibration_route": V.vibration_route,
    # extensions asked for by the brief, range lookups, time-range rolling
    "alerts": X.alerts,
    "trend_direction": X.trend_direction,
    "rms_anomalies": X.rms_anomalies,
    "days_to_zone_d": X.days_to_zone_d,
    "rms_forecast_7d": X.rms_forecast_7d,
    "ap_score": X.ap_score,
    "setup_runs": X.setup_runs,
    "downtime_by_reason": X.downtime_by_reason,
    "energy_by_shift_floor": X.energy_by_shift_floor,
    "bearing_flags": X.bearing_flags,
    "pf_by_floor_hour": X.pf_by_floor_hour,
    "shift_range_join": X.shift_range_join,
    "tariff_range_join": X.tariff_range_join,
    "rolling_7_days": X.rolling_7_days,
}


# no SQL equivalent: physical file layout / wall-clock run log
ROWS_ONLY = {"bronze_file_manifest", "run_audit"}


def query_fn(name: str) -> Callable[[SparkSession, str], DataFrame]:
    if name not in PLANS:
        from millstone.streaming.queries import STREAM_QUERIES
        return STREAM_QUERIES[name][0]
    plan = PLANS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(Pipeline(spark, sf_dir))
    run.__name__ = name
    run.__doc__ = plan.__doc__
    return run
