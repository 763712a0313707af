"""Profiling and data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.functions.numeric import stable
from millstone.functions.payload import key_count
from millstone.functions.timefn import epoch_micros, hour_start
from millstone.operators.dominant import category_counts, dominant
from millstone.operators.sequence import with_previous
from millstone.plans.catalog import Pipeline
from millstone.plans.gold import STATES, ZONES
from millstone.sources.refdata import ANOMALOUS_METER, MAIN_METER


def profile_by_version(p: Pipeline) -> DataFrame:
    """V1: rows, time range and distinct assets per schema version."""
    return p.bronze.groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_ts").alias("min_ts"),
        F.max("event_ts").alias("max_ts"), F.countDistinct("asset").alias("assets"))


def profile_payload_keys(p: Pipeline) -> DataFrame:
    """V2: distinct payload key sets per version (sorted, comma-joined)."""
    keys = F.array_join(F.array_sort(F.json_object_keys("payload")), ",")
    return p.bronze.groupBy("schema_version", F.coalesce(keys, F.lit("<invalid>")).alias("key_set")).agg(
        F.count(F.lit(1)).alias("rows"))


def profile_state_codes(p: Pipeline) -> DataFrame:
    """V3: state x status frequency on Silver production."""
    return p.production_events.groupBy("state_code", "status_code", "payload_format").agg(
        F.count(F.lit(1)).alias("rows"))


def profile_quality(p: Pipeline) -> DataFrame:
    """V4: quality counts per version and asset."""
    return p.bronze.groupBy("schema_version", "quality", "asset").agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(p: Pipeline) -> DataFrame:
    """V5: duplicate (asset, ts[, version]) groups and extra rows in Bronze."""
    g = p.bronze.groupBy("schema_version", "asset", "event_ts").agg(F.count(F.lit(1)).alias("c")) \
        .filter(F.col("c") > 1)
    return g.groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("duplicate_groups"), F.sum(F.col("c") - 1).cast("long").alias("extra_rows"))


def assert_unique_event_id(p: Pipeline) -> DataFrame:
    """Duplicate event ids per Silver table — every count must be 0."""
    def dups(name, df):
        g = df.groupBy("event_id").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
        return g.agg(F.count(F.lit(1)).alias("dup_event_ids")).select(F.lit(name).alias("tbl"), "dup_event_ids")
    a = dups("production_events", p.production_events)
    for n in ("vibration_events", "vibration_quarantine", "power_events"):
        a = a.unionByName(dups(n, getattr(p, n)))
    return a


def counter_resets(p: Pipeline) -> DataFrame:
    """V6: part-counter decreases between consecutive readings per machine."""
    s = p.production_events.select("asset", "event_ts", "parts_counter")
    x = with_previous(s, "asset", "event_ts", ["parts_counter"])
    r = x.filter(F.col("parts_counter") < F.col("prev_parts_counter"))
    return r.groupBy("asset").agg(F.count(F.lit(1)).alias("resets"),
                                  F.max(F.col("prev_parts_counter") - F.col("parts_counter")).cast("long").alias("max_drop"))


def profile_hierarchy(p: Pipeline) -> DataFrame:
    """V7: area x work center x asset message counts."""
    return p.bronze.groupBy("area", "work_center", "asset").agg(F.count(F.lit(1)).alias("rows"))


def quarantine_breakdown(p: Pipeline) -> DataFrame:
    """V8."""
    return p.vibration_quarantine.groupBy("asset", "schema_version", "quarantine_reason").agg(
        F.count(F.lit(1)).alias("cnt"))


def power_row_audit(p: Pipeline) -> DataFrame:
    """V9: per meter rows, local time range, anomaly rate."""
    return p.power_events.groupBy("asset").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_ts_local").alias("first_local"),
        F.max("event_ts_local").alias("last_local"),
        stable(F.avg(F.col("is_anomaly").cast("int"))).alias("anomaly_rate"))


def peak_hour_audit(p: Pipeline) -> DataFrame:
    """Peak-hour truth table."""
    return p.power_events.groupBy("hour_local", "day_of_week", "is_peak_hour", "is_weekend").agg(
        F.count(F.lit(1)).alias("cnt"))


def energy_counter_range(p: Pipeline) -> DataFrame:
    """Cumulative counter range per meter (non-anomalous meters)."""
    s = p.power_events.filter(~F.col("is_anomaly"))
    return s.groupBy("asset", "floor_num").agg(
        stable(F.min("energy_kwh_cumul")).alias("min_kwh_cumul"),
        stable(F.max("energy_kwh_cumul")).alias("max_kwh_cumul"),
        stable(F.max("energy_kwh_cumul") - F.min("energy_kwh_cumul")).alias("total_kwh"))


def row_count_audit(p: Pipeline) -> DataFrame:
    """Silver row counts as a labelled UNION ALL."""
    parts = [p.production_events, p.vibration_events, p.vibration_quarantine, p.power_events]
    names = ["PRODUCTION_EVENTS", "VIBRATION_EVENTS", "VIBRATION_QUARANTINE", "POWER_EVENTS"]
    out = None
    for n, d in zip(names, parts):
        c = d.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("tbl"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def kw_by_weekday(p: Pipeline) -> DataFrame:
    """Mean active power by local day name."""
    return p.power_events.groupBy(F.date_format(F.to_date("event_ts_local"), "EEE").alias("day_name")).agg(
        stable(F.avg("active_power_kw")).alias("avg_kw"), F.count(F.lit(1)).alias("readings"))


def coverage_gaps(p: Pipeline, min_gap_hours: float = 2.0) -> DataFrame:
    """Silences longer than ``min_gap_hours`` between consecutive
    readings of a motor."""
    s = p.vibration_events.select("asset", "event_ts")
    x = with_previous(s, "asset", "event_ts", [])
    # computed from calendar fields: timestamp_diff would follow the session zone
    gap_s = (epoch_micros("event_ts") - epoch_micros("prev_event_ts")) / F.lit(1e6)
    return x.filter(gap_s > min_gap_hours * 3600).select(
        "asset", F.col("prev_event_ts").alias("gap_start"), F.col("event_ts").alias("gap_end"),
        stable(gap_s / 3600).alias("gap_hours"))


def meter_reconciliation(p: Pipeline) -> DataFrame:
    """Per local hour, main meter vs the sum of the floor meters
    (the anomalous meter duplicates the main board and is left out)."""
    h = p.energy_hourly
    main = F.when(F.col("asset") == MAIN_METER, F.col("hourly_kwh"))
    sub = F.when((F.col("asset") != MAIN_METER) & (F.col("asset") != ANOMALOUS_METER), F.col("hourly_kwh"))
    g = h.groupBy("hour_local").agg(F.sum(main).alias("_main"), F.sum(sub).alias("_sub"))
    return g.select("hour_local", stable("_main").alias("main_kwh"), stable("_sub").alias("sub_kwh"),
                    stable(F.col("_main") - F.col("_sub")).alias("diff_kwh"))


def json_key_count(p: Pipeline) -> DataFrame:
    """key-count distribution per version (NULL = unparsable)."""
    return p.bronze.groupBy("schema_version", key_count("payload").alias("n_keys")).agg(
        F.count(F.lit(1)).alias("rows"))


def vibration_route(p: Pipeline) -> DataFrame:
    """A12/T11 conservation: vibration messages in = events + quarantine +
    dropped duplicates, per version."""
    r = p.vibration_routed
    inn = r.groupBy("schema_version").agg(F.count(F.lit(1)).alias("routed"),
                                          F.count_if(F.col("route") == "events").alias("to_events"),
                                          F.count_if(F.col("route") == "quarantine").alias("to_quarantine"))
    ev = p.vibration_events.groupBy("schema_version").agg(F.count(F.lit(1)).alias("events_rows"))
    q = p.vibration_quarantine.groupBy("schema_version").agg(F.count(F.lit(1)).alias("quarantine_rows"))
    out = inn.join(ev, "schema_version", "left").join(q, "schema_version", "left")
    return out.select("*", (F.col("routed") - F.coalesce("events_rows", F.lit(0))
                            - F.coalesce("quarantine_rows", F.lit(0))).alias("duplicates_dropped"))



def _tally(pred, name: str) -> list:
    """Rows where ``pred`` is TRUE, FALSE and UNKNOWN (a filter keeps TRUE only)."""
    return [F.count_if(pred).alias(f"{name}_true"), F.count_if(~pred).alias(f"{name}_false"),
            F.count_if(pred.isNull()).alias(f"{name}_null")]


def filter_three_valued(p: Pipeline) -> DataFrame:
    """Comparisons and AND/OR/NOT under three-valued logic.  A NULL
    ingest time or asset makes the comparison UNKNOWN; UNKNOWN AND FALSE is
    FALSE, UNKNOWN OR TRUE is TRUE."""
    prompt = F.col("ingested_ts") <= F.col("event_ts") + F.make_dt_interval(secs=F.lit(2))
    not_main = F.col("asset") != F.lit(MAIN_METER)
    return p.bronze.groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("rows"),
        *_tally(prompt, "prompt"), *_tally(not_main, "not_main"),
        *_tally(prompt & not_main, "both"), *_tally(prompt | not_main, "either"))


def like_ilike(p: Pipeline) -> DataFrame:
    """Prefix LIKE on names and case-insensitive ILIKE '%60%' on the
    payload's source period (the 60 s layout test); a missing value leaves
    the match UNKNOWN, counted apart."""
    period = F.get_json_object("payload", "$.source_period")
    sixty = period.ilike("%60%")
    meter = F.col("asset").like("PM-F%")
    return p.bronze.groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("schema_version").like("vibration%")).alias("vibration_prefix"),
        F.count_if(F.col("asset").ilike("fm%")).alias("forming_ilike"),
        F.count_if(meter).alias("meter_prefix"), F.count_if(~meter).alias("not_meter_prefix"),
        F.count_if(sixty).alias("period_60"), F.count_if(sixty.isNull()).alias("period_unknown"))


def _domains() -> dict:
    v = F.col("schema_version")
    return {"production": v == S.V_PRODUCTION, "vibration": v.startswith("vibration."),
            "power": v == S.V_POWER}


def bronze_by_domain(p: Pipeline) -> DataFrame:
    """One discriminator-filtered read per domain.  On the derived raw
    table each filter prunes the other union branches at plan time; on a
    landed table partitioned by ``schema_version`` it is partition pruning.
    The three reads are disjoint, so together they scan the table once."""
    parts = [p.bronze.filter(cond).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("asset").alias("assets"),
        F.count_if(F.col("ingested_ts").isNull()).alias("null_ingest"),
        F.min("event_ts").alias("min_ts"), F.max("event_ts").alias("max_ts"),
    ).select(F.lit(name).alias("domain"), "*") for name, cond in _domains().items()]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


def _dominant_hourly(p: Pipeline, col: str, categories: list[str], tie_order: list[str], name: str) -> DataFrame:
    """G9/W4 on its own: the modal ``col`` per asset and hour, as one
    aggregate with conditional counts and an arg-max (no rank window)."""
    g = p.vibration_events.filter(F.col(col).isNotNull()).groupBy(
        "asset", hour_start("event_ts").alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("readings"), *category_counts(col, categories, "_n_"))
    return g.select("asset", "hour_utc", dominant(tie_order, "_n_").alias(name), "readings")


def dominant_zone_hourly(p: Pipeline) -> DataFrame:
    """Ties go to the worse zone."""
    return _dominant_hourly(p, "iso_zone", ZONES, list(reversed(ZONES)), "dominant_iso_zone")


def dominant_state_hourly(p: Pipeline) -> DataFrame:
    """Ties go to the alphabetically first state."""
    return _dominant_hourly(p, "machine_state", STATES, sorted(STATES), "dominant_machine_state")


def payload_types(p: Pipeline) -> DataFrame:
    """F7 (TYPEOF): per schema version, the JSON type of the payload (key ``''``)
    and of each of its keys, over all messages.  The text is parsed once into a
    VARIANT; text that does not parse is INVALID."""
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    raw = p.bronze.select("schema_version", F.try_parse_json("payload").alias("v")).withColumn("whole", kind("v"))
    keys = raw.lateralJoin(p.spark.tvf.variant_explode_outer(F.col("v").outer()))
    entry = lambda key, t: F.array(F.struct(key.alias("key"), t.alias("type")))
    none = F.filter(entry(F.lit(""), F.col("whole")), lambda x: F.lit(False))
    types = keys.select("schema_version", F.inline(F.concat(
        F.when(F.coalesce("pos", F.lit(0)) == 0, entry(F.lit(""), F.col("whole"))).otherwise(none),
        F.when(F.col("key").isNotNull(), entry(F.col("key"), kind("value"))).otherwise(none))))
    number = F.col("type").isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    return types.groupBy("schema_version", "key", F.when(F.col("type").isNull(), "INVALID").when(number, "NUMBER")
                         .otherwise(F.col("type")).alias("json_type")).agg(F.count(F.lit(1)).alias("messages"))
