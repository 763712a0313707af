"""Fixed schemas: Bronze envelope, payload layouts, Silver tables."""

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw message envelope (one row per sensor message; payload is JSON text).
BRONZE = _struct(
    ("event_ts", TS), ("enterprise", S), ("site", S), ("area", S),
    ("work_center", S), ("work_cell", S), ("asset", S), ("asset_path", S),
    ("namespace", S), ("quality", S), ("payload", S), ("ingested_ts", TS),
    ("schema_version", S), ("source", S), ("correlation_id", S),
)

# Schema versions (discriminator values of the raw table) — fixed values.
V_PRODUCTION = "0.1"
V_VIBRATION_1 = "vibration.raw.v1"
V_VIBRATION_2 = "vibration.raw.v2"
V_POWER = "power_meter.raw.v1"
VIBRATION_VERSIONS = (V_VIBRATION_1, V_VIBRATION_2)

# Payload read schemas.  Every key is read as its text and typed afterwards: a
# number may come as text ("800"), and a 64-bit integer does not fit a double.
PRODUCTION_PAYLOAD = _struct(
    ("n3_state_code", S), ("machine_status_heartbeat", S),
    ("n3_status_code", S), ("n3_reason_code", S), ("reason_code_60", S),
    ("wo_part_counter_delta", S), ("wo_part_counter_delta_60", S),
    ("wo_part_counter_no_reset", S), ("counter", S),
    ("wo_name", S), ("wo_part_name", S), ("plan_id", S),
    ("wo_cycle_time", S), ("source_period", S),
)

VIBRATION_PAYLOAD = _struct(
    ("rotational_speed_rpm", S), ("rotational_speed_hz", S), ("temperature_c", S),
    ("x_rms_velocity_mm_s", S), ("x_peak_acceleration_g", S), ("x_crest_factor", S),
    ("x_kurtosis", S), ("z_rms_velocity_mm_s", S),
    ("device_available", S), ("device_error", S),
)

POWER_PAYLOAD = _struct(
    ("floor", S), ("eq_active_power", S), ("eq_apparent_power", S),
    ("eq_reactive_power", S), ("eq_power_factor", S), ("frequency", S),
    ("eq_phase_v", S), ("eq_phase_to_phase_voltage", S), ("eq_current", S),
    ("total_import_active_energy", S), ("total_import_reactive_energy", S),
    ("total_apparent_energy", S),
)

PRODUCTION_EVENTS_COLS = [
    "event_id", "event_ts", "event_ts_local", "ingested_ts", "enterprise", "site",
    "area", "work_center", "work_cell", "asset", "schema_version", "source",
    "quality", "payload_format", "source_period_sec", "state_code", "status_code",
    "reason_code", "parts_delta", "parts_counter", "counter", "wo_name",
    "wo_part_name", "plan_id", "wo_cycle_time_sec", "is_producing",
    "downtime_category", "machine_category",
]

VIBRATION_EVENTS_COLS = [
    "event_id", "event_ts", "event_ts_local", "ingested_ts", "enterprise", "site",
    "area", "work_center", "work_cell", "asset", "schema_version", "source",
    "quality", "is_full_payload", "rotational_speed_rpm", "rotational_speed_hz",
    "temperature_c", "x_rms_velocity_mm_s", "x_peak_acceleration_g",
    "x_crest_factor", "x_kurtosis", "z_rms_velocity_mm_s", "device_available",
    "device_error", "machine_state", "iso_zone", "is_quarantined",
]

QUARANTINE_COLS = [
    "event_id", "event_ts", "asset", "schema_version", "quality",
    "quarantine_reason", "raw_payload",
]

POWER_EVENTS_COLS = [
    "event_id", "event_ts", "event_ts_local", "ingested_ts", "enterprise", "site",
    "area", "work_center", "asset", "quality", "schema_version", "source",
    "correlation_id", "floor_num", "active_power_kw", "apparent_power_kva",
    "reactive_power_kvar", "power_factor", "frequency_hz", "phase_voltage_v",
    "line_voltage_v", "current_a", "energy_kwh_cumul", "energy_kvarh_cumul",
    "energy_kvah_cumul", "is_peak_hour", "is_weekend", "hour_local",
    "day_of_week", "shift_name", "is_anomaly",
]
