"""Silver: typed, deduplicated, enriched event tables.

Pure ``DataFrame -> DataFrame`` functions over a Bronze frame; the same
functions run in a backfill and inside a streaming ``foreachBatch``.

Physical shape of each: scan (discriminator filter pushed to Parquet) ->
parse + type in the scan stage -> ONE hash exchange on the dedup key ->
classify; the reference-table join is a broadcast of a fixed 38-row table.
Typed columns, not the raw JSON text, cross the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.functions import classify as K
from millstone.functions.payload import is_object, json_double, json_int, key_count, key_present, parse, text_flag, text_int
from millstone.functions.timefn import event_id, iso_dow, to_local
from millstone.operators.dedup import latest_per_key

HIERARCHY = ["enterprise", "site", "area", "work_center", "work_cell", "asset"]


def _tiebreak():
    # deterministic last resort when two copies share key and ingest time
    return F.xxhash64("payload").alias("_tiebreak")


def _built_once(messages: DataFrame) -> DataFrame:
    """The payload as a generated column: a filter on it stays above the text.
    Pushed into the projection that builds the text, it would build it again,
    and once more for each of its uses, without shared subexpressions."""
    return messages.withColumn("payload", F.explode(F.array("payload")))


def silver_production(bronze: DataFrame, machine_config: DataFrame,
                      strict_reference: bool = False, dedup=latest_per_key) -> DataFrame:
    """D1.  ``strict_reference=True`` keeps the original status rule where a
    60 s message (no status key) can never be EXCLUDED.  ``dedup(df, keys)``
    picks the surviving delivery per key (default: latest ingest wins).  Text
    that is no JSON object goes to ``silver_unparsable`` instead."""
    src = _built_once(bronze.filter(F.col("schema_version") == S.V_PRODUCTION)).filter(is_object("payload"))
    p = parse("payload", S.PRODUCTION_PAYLOAD)
    typed = src.select(
        event_id().alias("event_id"), "event_ts", to_local("event_ts").alias("event_ts_local"),
        "ingested_ts", *HIERARCHY, "schema_version", "source", "quality",
        K.payload_format(key_present("payload", "n3_state_code"),
                         key_present("payload", "machine_status_heartbeat")).alias("payload_format"),
        p.alias("p"), _tiebreak(),
    ).select(
        "*",
        F.coalesce(json_int("p.n3_state_code"), json_int("p.machine_status_heartbeat")).alias("state_code"),
        json_int("p.n3_status_code").alias("_status"),
        F.coalesce(json_int("p.n3_reason_code"), json_int("p.reason_code_60")).alias("reason_code"),
        F.coalesce(json_int("p.wo_part_counter_delta"), json_int("p.wo_part_counter_delta_60")).alias("parts_delta"),
        json_int("p.wo_part_counter_no_reset").alias("parts_counter"),
        json_int("p.counter").alias("counter"),
        F.col("p.wo_name").alias("wo_name"), F.col("p.wo_part_name").alias("wo_part_name"),
        F.col("p.plan_id").alias("plan_id"), json_double("p.wo_cycle_time").alias("wo_cycle_time_sec"),
        K.source_period_sec("p.source_period").alias("source_period_sec"),
    ).drop("p")
    deduped = dedup(typed, ["asset", "event_ts"])
    status = F.col("_status") if strict_reference else \
        F.coalesce(F.col("_status"), F.col("state_code") * 1000 + F.col("reason_code"))
    mc = F.broadcast(machine_config.select("asset", F.col("machine_category").alias("_cfg_cat")))
    out = (deduped.join(mc, "asset", "left")
           .withColumn("machine_category", F.coalesce("_cfg_cat", F.lit("ACTIVE_PRODUCER")))
           .withColumn("status_code", status))
    out = out.select(
        "*",
        K.downtime_category("state_code", "status_code").alias("downtime_category"),
        K.is_producing("state_code", "parts_delta", "machine_category").alias("is_producing"),
    )
    return out.select(*S.PRODUCTION_EVENTS_COLS)


def route_vibration(bronze: DataFrame) -> DataFrame:
    """One pass over vibration messages, tagged ``events`` or ``quarantine``
    (A12/ST12).  Full GOOD payloads (> 5 keys) go to events; BAD, sparse,
    and unparsable messages go to quarantine with a reason."""
    src = _built_once(bronze.filter(F.col("schema_version").isin(*S.VIBRATION_VERSIONS)))
    n = key_count("payload")
    good = F.coalesce((F.col("quality") == "GOOD") & (n > K.SPARSE_MAX_KEYS), F.lit(False))
    keyed = F.col("asset").isNotNull() & F.col("event_ts").isNotNull()
    return (src.withColumn("n_keys", n)
               .withColumn("route", F.when(good, "events").when(keyed, "quarantine"))
               .filter(F.col("route").isNotNull()))


def silver_vibration(routed: DataFrame, dedup=latest_per_key) -> DataFrame:
    """D3 (input: ``route_vibration`` output)."""
    p = parse("payload", S.VIBRATION_PAYLOAD)
    typed = routed.filter(F.col("route") == "events").select(
        event_id().alias("event_id"), "event_ts", to_local("event_ts").alias("event_ts_local"),
        "ingested_ts", *HIERARCHY, "schema_version", "source", "quality",
        F.lit(True).alias("is_full_payload"), p.alias("p"), _tiebreak(),
    ).select(
        "*",
        *[json_double(f"p.{k}").alias(a) for k, a in [
            ("rotational_speed_rpm", "rotational_speed_rpm"), ("rotational_speed_hz", "rotational_speed_hz"),
            ("temperature_c", "temperature_c"), ("x_rms_velocity_mm_s", "x_rms_velocity_mm_s"),
            ("x_peak_acceleration_g", "x_peak_acceleration_g"), ("x_crest_factor", "x_crest_factor"),
            ("x_kurtosis", "x_kurtosis"), ("z_rms_velocity_mm_s", "z_rms_velocity_mm_s")]],
        text_flag("p.device_available").alias("device_available"),
        text_flag("p.device_error").alias("device_error"),
    ).drop("p")
    deduped = dedup(typed, ["asset", "event_ts", "schema_version"])
    out = deduped.select(
        "*",
        K.motor_state("device_available", "rotational_speed_rpm").alias("machine_state"),
        K.iso_zone("x_rms_velocity_mm_s").alias("iso_zone"),
        F.lit(False).alias("is_quarantined"),
    )
    return out.select(*S.VIBRATION_EVENTS_COLS)


def silver_quarantine(routed: DataFrame) -> DataFrame:
    """D2, deduplicated on the same key as the events table."""
    q = routed.filter(F.col("route") == "quarantine").select(
        event_id().alias("event_id"), "event_ts", "asset", "schema_version", "quality",
        K.quarantine_reason("quality", "n_keys").alias("quarantine_reason"),
        F.col("payload").alias("raw_payload"), "ingested_ts", _tiebreak(),
    )
    return latest_per_key(q, ["asset", "event_ts", "schema_version"]).select(*S.QUARANTINE_COLS)


def silver_unparsable(bronze: DataFrame) -> DataFrame:
    """Production and power messages whose text is no JSON object (NULL,
    cut off, another JSON type), kept with their text instead of becoming
    events of NULLs.  Meter rows that D4 ignores are not routed either."""
    power = (F.col("schema_version") == S.V_POWER) & (F.col("quality") != "BAD")
    src = _built_once(bronze.filter(((F.col("schema_version") == S.V_PRODUCTION) | power)
                                    & F.col("asset").isNotNull() & F.col("event_ts").isNotNull()))
    q = src.filter(~is_object("payload")).select(
        event_id().alias("event_id"), "event_ts", "asset", "schema_version", "quality",
        F.lit("UNROUTABLE").alias("quarantine_reason"), F.col("payload").alias("raw_payload"),
        "ingested_ts", _tiebreak())
    return latest_per_key(q, ["asset", "event_ts", "schema_version"]).select(*S.QUARANTINE_COLS)


def silver_power(bronze: DataFrame, dedup=latest_per_key) -> DataFrame:
    """GOOD (non-BAD, non-NULL quality) meter readings with time context."""
    src = _built_once(bronze.filter((F.col("schema_version") == S.V_POWER) & (F.col("quality") != "BAD")
                                    & F.col("asset").isNotNull())).filter(is_object("payload"))
    p = parse("payload", S.POWER_PAYLOAD)
    typed = src.select(
        event_id().alias("event_id"), "event_ts", to_local("event_ts").alias("event_ts_local"),
        "ingested_ts", "enterprise", "site", "area", "work_center", "asset", "quality",
        "schema_version", "source", "correlation_id", p.alias("p"), _tiebreak(),
    ).select(
        "*",
        text_int("p.floor").alias("floor_num"),
        json_double("p.eq_active_power").alias("active_power_kw"),
        json_double("p.eq_apparent_power").alias("apparent_power_kva"),
        json_double("p.eq_reactive_power").alias("reactive_power_kvar"),
        json_double("p.eq_power_factor").alias("power_factor"),
        json_double("p.frequency").alias("frequency_hz"),
        json_double("p.eq_phase_v").alias("phase_voltage_v"),
        json_double("p.eq_phase_to_phase_voltage").alias("line_voltage_v"),
        json_double("p.eq_current").alias("current_a"),
        json_double("p.total_import_active_energy").alias("energy_kwh_cumul"),
        json_double("p.total_import_reactive_energy").alias("energy_kvarh_cumul"),
        json_double("p.total_apparent_energy").alias("energy_kvah_cumul"),
    ).drop("p")
    deduped = dedup(typed, ["asset", "event_ts"])
    loc = F.col("event_ts_local")
    out = deduped.select(
        "*",
        K.is_peak_hour(loc).alias("is_peak_hour"), K.is_weekend(loc).alias("is_weekend"),
        F.hour(loc).alias("hour_local"), iso_dow(loc).alias("day_of_week"),
        K.shift_name(loc).alias("shift_name"), K.is_anomalous_meter("asset").alias("is_anomaly"),
    )
    return out.select(*S.POWER_EVENTS_COLS)


__all__ = ["silver_production", "route_vibration", "silver_vibration", "silver_quarantine", "silver_unparsable",
           "silver_power"]
