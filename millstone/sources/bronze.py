"""Bronze: the raw message table.

* ``load_bronze`` — batch read of Parquet with a fixed schema, matched to
  columns by name case-insensitively (A1/A2).
* ``file_manifest`` — per-file listing of what a load would read (A4).
* ``bronze_from_events`` — the deterministic stand-in for the plant's raw
  table, derived row-by-row from the driver's ``events`` table (FIXTURES §4).
  It is a narrow map (``explode`` of a fixed 6-offset array, no join), so it
  scales with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.functions.timefn import epoch_micros


def load_bronze(spark: SparkSession, *paths: str, partition_by_version: bool = False) -> DataFrame:
    """Read one or more Parquet prefixes into the Bronze schema.  Column
    names are matched case-insensitively; missing columns come back NULL."""
    df = spark.read.parquet(*paths)
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in S.BRONZE.fields:
        src = lower.get(f.name)
        cols.append((F.col(f"`{src}`").cast(f.dataType) if src else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def file_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Per input file: path, size, row count — the 'list the stage' step."""
    df = spark.read.parquet(*paths).select("_metadata.file_path", "_metadata.file_size")
    return (df.groupBy("file_path", "file_size")
              .agg(F.count(F.lit(1)).alias("row_count")))


# ---------------------------------------------------------------------------
# Stand-in raw table derived from `events` (fixed rules, see FIXTURES.md §4)
# ---------------------------------------------------------------------------

OFFSETS = 6            # each event becomes 6 readings, 10 minutes apart
COPY_EVERY = 25        # every 25th event is delivered twice (later ingest)
NULL_INGEST_EVERY = 97
SIXTY_S_EVERY = 20
BAD_JSON_EVERY = 307
SPARSE_EVERY = 211
OFFLINE_EVERY = 50
BAD_METER_EVERY = 500
TEXT_FLOOR_MOD = (100, 1)
EPOCH_US_2024 = 1704067200000000   # 2024-01-01 00:00:00 UTC in µs
V2_FROM = "2024-01-16 00:00:00"
#: of the stored events a task of the fan-out gets so much: a writer sorts the messages of
#: a task, and some hundred thousand with their text still fit its memory
TASK_BYTES = 1 << 20


def _explode_readings(ev: DataFrame) -> DataFrame:
    copies = F.when(F.col("event_id") % COPY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (ev.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))))
              .withColumn("c", F.explode(copies)))


def bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of three per-domain projections of ``events``.  Each branch
    filters ``event_type`` (pushed to the Parquet scan) and carries a
    constant or CASE ``schema_version``, so a downstream filter on the
    discriminator prunes whole branches at plan time."""
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    ev = stored.select("event_id", "ts", "user_id", "event_type", "value", "props")
    # Each event fans out into 6-12 messages with JSON built per message: the
    # narrow events are dealt out first, at any size, so that the fan-out does
    # not follow the input's file layout.
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    ev = ev.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES)), "event_id")
    parts = [_domain_rows(ev, d) for d in ("production", "vibration", "power")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_EVENT_TYPES = {"production": ["view", "click"], "vibration": ["error"], "power": ["purchase", "signup"]}


def _domain_rows(ev: DataFrame, dom: str) -> DataFrame:
    # k0 is read once per event, below the fan-out: a filter on the payload is pushed
    # down to the fan-out and would read it from the text for each of its uses
    x = _explode_readings(ev.filter(F.col("event_type").isin(*_EVENT_TYPES[dom]))
                          .withColumn("k0", F.get_json_object("props", "$.k").cast("int")))
    eid, uid, i, c, k0 = F.col("event_id"), F.col("user_id"), F.col("i"), F.col("c"), F.col("k0")
    x = x.select(
        "*",
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), i * 10, F.lit(0))).alias("event_ts"),
        ((k0 + 7 * i) % 100).alias("k"),
    )
    secs = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)
    ingested = (F.when(c == 1, F.col("event_ts") + secs(F.lit(65)))
                 .when(eid % NULL_INGEST_EVERY == 0, F.lit(None).cast("timestamp_ntz"))
                 .otherwise(F.col("event_ts") + secs(1 + eid % 5)))
    none = F.lit(None).cast("string")
    if dom == "production":
        version = F.lit(S.V_PRODUCTION)
        asset = F.concat(F.lit("FM"), (11 + uid % 38).cast("string"))
        work_center = F.concat(F.lit("Group"), (1 + (uid % 38) % 4).cast("string"))
        area, quality, work_cell = F.lit("forming"), F.lit("GOOD"), none
    elif dom == "vibration":
        is_v1 = F.col("ts") < F.lit(V2_FROM).cast("timestamp_ntz")
        version = F.when(is_v1, S.V_VIBRATION_1).otherwise(S.V_VIBRATION_2)
        asset = F.concat(F.lit("motor_0"), (1 + uid % 4).cast("string"))
        work_center, area = F.lit("chiller"), F.lit("utilities")
        quality = F.when(F.col("k") < 3, "BAD").otherwise("GOOD")
        work_cell = asset
    else:
        version = F.lit(S.V_POWER)
        meter_bad = eid % BAD_METER_EVERY == 0
        meter = F.when(uid % 8 == 0, "MAIN-MDB").otherwise(F.concat(F.lit("PM-F"), (uid % 8).cast("string")))
        asset = F.when(meter_bad, none).otherwise(meter)
        work_center, area, work_cell = F.lit("electrical"), F.lit("power"), none
        quality = F.when(meter_bad, "BAD").otherwise("GOOD")
    x = x.select("*", ingested.alias("ingested_ts"), version.alias("schema_version"), asset.alias("asset"),
                 work_center.alias("work_center"), area.alias("area"), quality.alias("quality"),
                 work_cell.alias("work_cell"))
    payload = {"production": _production_payload, "vibration": _vibration_payload,
               "power": _power_payload}[dom]()
    return x.select(
        "event_ts", F.lit("Acme").alias("enterprise"), F.lit("Plant1").alias("site"), "area",
        "work_center", "work_cell", "asset",
        F.concat_ws("/", F.lit("Acme"), F.lit("Plant1"), F.col("area"), F.col("work_center"), F.col("asset")).alias("asset_path"),
        F.lit("uns").alias("namespace"), "quality", payload.alias("payload"), "ingested_ts",
        "schema_version", F.lit("gateway").alias("source"),
        F.concat_ws("-", eid.cast("string"), i.cast("string"), c.cast("string")).alias("correlation_id"),
    )


def _production_payload():
    k, eid, uid, c = F.col("k"), F.col("event_id"), F.col("user_id"), F.col("c")
    state = F.when(k < 40, 800).when(k < 55, 801).when(k < 95, 803)
    r = k % 4
    reason = F.when(state == 803, F.when(r == 0, 105).when(r == 1, 101).when(r == 2, 112).otherwise(102)).otherwise(0)
    delta = F.when((state == 800) & ~F.col("asset").isin("FM44", "FM48"), eid % 3 + c).otherwise(0)
    three = F.to_json(F.struct(
        F.lit(1).alias("connected"), eid.alias("counter"),
        state.alias("n3_state_code"), (state * 1000 + reason).alias("n3_status_code"),
        reason.alias("n3_reason_code"), F.concat(F.lit("P"), (eid % 3).cast("string")).alias("plan_id"),
        F.lit(1000).alias("qty_to_produce"), F.lit("3s").alias("source_period"),
        F.col("value").alias("wo_cycle_time"), F.concat(F.lit("WO-"), (uid % 7).cast("string")).alias("wo_name"),
        delta.alias("wo_part_counter_delta"), (eid * 6 + F.col("i")).alias("wo_part_counter_no_reset"),
        F.concat(F.lit("PART-"), (uid % 5).cast("string")).alias("wo_part_name"),
    ))
    sixty = F.to_json(F.struct(
        F.lit(1).alias("connected"), state.alias("machine_status_heartbeat"),
        reason.alias("reason_code_60"), delta.alias("wo_part_counter_delta_60"),
        F.lit("60s").alias("source_period"), F.lit("A").alias("shift_window"),
        F.lit(0).alias("wo_downtime_60"),
    ))
    return F.when(eid % SIXTY_S_EVERY == 0, sixty).otherwise(three)


def _vibration_payload():
    k, eid, v = F.col("k"), F.col("event_id"), F.col("value")
    rpm = k * 20
    avail = F.when(eid % OFFLINE_EVERY == 0, 0).otherwise(1)
    full = F.to_json(F.struct(
        rpm.alias("rotational_speed_rpm"), (rpm / 60).alias("rotational_speed_hz"),
        (30 + k / 5).alias("temperature_c"), (v / 10).alias("x_rms_velocity_mm_s"),
        (v / 50).alias("x_peak_acceleration_g"), (2 + k / 20).alias("x_crest_factor"),
        (2 + k / 25).alias("x_kurtosis"), (v / 20).alias("z_rms_velocity_mm_s"),
        avail.alias("device_available"), F.lit(0).alias("device_error"),
    ))
    sparse = F.to_json(F.struct(
        avail.alias("device_available"), F.lit(0).alias("device_error"),
        F.lit("sensor fault").alias("quality_detail"),
        F.concat(F.lit("vibration/"), F.col("asset")).alias("source_topic"),
    ))
    is_sparse = ((F.col("quality") == "BAD") & (F.col("schema_version") == S.V_VIBRATION_2)) | (eid % SPARSE_EVERY == 0)
    return F.when(eid % BAD_JSON_EVERY == 0, F.lit("{bad")).when(is_sparse, sparse).otherwise(full)


def _power_payload():
    k, eid, uid = F.col("k"), F.col("event_id"), F.col("user_id")
    mult = 1 + uid % 8
    kwh = ((epoch_micros("event_ts") - F.lit(EPOCH_US_2024)).cast("double")
           / F.lit(3600000000.0) * mult)
    pf = 0.80 + k / 500
    active = 10 * mult + k / 10
    floor = F.when(eid % TEXT_FLOOR_MOD[0] == TEXT_FLOOR_MOD[1], F.concat(F.lit("F"), (uid % 8).cast("string"))) \
        .otherwise((uid % 8).cast("string"))
    return F.to_json(F.struct(
        F.concat(F.lit("meter-"), (uid % 8).cast("string")).alias("device_id"),
        floor.alias("floor"), F.lit(50.0).alias("frequency"),
        active.alias("eq_active_power"), (active / pf).alias("eq_apparent_power"),
        (active * 0.3).alias("eq_reactive_power"), (active * 2).alias("eq_current"),
        pf.alias("eq_power_factor"), F.lit(230.0).alias("eq_phase_v"),
        F.lit(400.0).alias("eq_phase_to_phase_voltage"),
        kwh.alias("total_import_active_energy"), (kwh * 0.3).alias("total_import_reactive_energy"),
        (kwh * 1.05).alias("total_apparent_energy"),
    ))
