"""Registered streaming queries: the raw messages derived from the input
folder are landed as files, consumed by the per-domain streaming query in
several micro-batches, and the resulting table is returned.  They must
equal the batch backfill (ST13) — same oracle as their batch twins."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.plans import extensions, registry
from millstone.plans.catalog import Pipeline
from millstone.session import scratch_path, side_by_side
from millstone.sources.bronze import bronze_from_events
from millstone.streaming.alert_history import alert_history, standing
from millstone.streaming.commits import commits
from millstone.streaming.gold_refresh import run_gold_stream
from millstone.streaming.runners import (
    deliver, drops_by_key, drops_by_slot, ingest_files, run_pipeline_stream, run_silver_stream)

DROPS = 4       # deliveries per replayed table, of any size
VERSIONS = {"production": [S.V_PRODUCTION], "vibration": list(S.VIBRATION_VERSIONS), "power": [S.V_POWER]}


def _run(spark: SparkSession, sf_dir: str, domain: str, pipeline: bool, by_slot: bool = False) -> str:
    root = scratch_path(spark, f"stream-run/{domain}-{uuid.uuid4().hex}")
    raw = bronze_from_events(spark, sf_dir).filter(F.col("schema_version").isin(*VERSIONS[domain]))
    runner = run_pipeline_stream if pipeline else run_silver_stream
    deliver(drops_by_slot(raw) if by_slot else drops_by_key(raw, DROPS), root, lambda landing: runner(
        spark, landing, f"{root}/tables", f"{root}/checkpoints", domain), keep=False)
    return f"{root}/tables"


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST14/X11/G16: the commit log of the production pipeline stream (rows in,
    written and quarantined per micro-batch) with the Gold ``last_refresh`` (max
    ``loaded_at``).  Wall-clock values: rows-only check."""
    tables = _run(spark, sf_dir, "production", True)
    last = spark.read.parquet(f"{tables}/production_hourly").select(F.max("loaded_at")).scalar()
    return commits(spark, tables).withColumn("last_refresh", last)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST14/U2/X11: per stream, what its commits say they read, wrote and
    rejected over all deliveries."""
    tables = side_by_side(*[partial(_run, spark, sf_dir, d, False) for d in VERSIONS])      # each stream has its own tables
    logs = [commits(spark, t) for t in tables]
    log = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return log.groupBy("stream").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows_in").alias("rows_in"), F.sum("rows_written").alias("rows_written"),
        F.sum("rows_quarantined").alias("rows_quarantined"))


def bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: incremental file ingest.  Raw files land in two drops; a file
    stream appends them to the Bronze table and is
    restarted between drops.  Its checkpoint remembers the loaded files, so
    the second run loads only the new ones: every message lands once."""
    from millstone.plans import profiling as V
    root = scratch_path(spark, f"stream-ingest/{uuid.uuid4().hex}")
    raw = bronze_from_events(spark, sf_dir)
    is_power = F.col("schema_version") == S.V_POWER
    for drop in (~is_power, is_power):
        raw.filter(drop).write.mode("append").parquet(f"{root}/landing")
        ingest_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoints/bronze")
    return V.profile_by_version(Pipeline(spark, sf_dir, bronze_dir=f"{root}/bronze"))


def _view(spark, sf_dir, tables) -> Pipeline:
    """Silver/Gold frames read from the tables the stream wrote."""
    return Pipeline(spark, sf_dir, tables_dir=tables)


def stream_silver_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.PLANS["silver_production"](_view(spark, sf_dir, _run(spark, sf_dir, "production", False)))


def stream_silver_vibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.PLANS["silver_vibration"](_view(spark, sf_dir, _run(spark, sf_dir, "vibration", False)))


def stream_silver_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.PLANS["silver_power"](_view(spark, sf_dir, _run(spark, sf_dir, "power", False)))


def stream_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a message in different micro-batches; the written
    table keeps the first."""
    return registry.PLANS["silver_production"](
        _view(spark, sf_dir, _run(spark, sf_dir, "production", False, by_slot=True)))


def stream_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a message in different micro-batches; the last one
    replaces every non-key column of the written row."""
    return registry.PLANS["silver_power"](_view(spark, sf_dir, _run(spark, sf_dir, "power", False, by_slot=True)))


def stream_gold_production_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir, _run(spark, sf_dir, "production", True))
    return registry.PLANS["production_hourly"](v).drop("loaded_at", "hour_date")


def stream_gold_vibration_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir, _run(spark, sf_dir, "vibration", True))
    return registry.PLANS["vibration_hourly"](v).drop("loaded_at", "hour_date")


def stream_gold_energy_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: hourly energy after upserts that reach already published hours."""
    v = _view(spark, sf_dir, _run(spark, sf_dir, "power", True, by_slot=True))
    return registry.PLANS["energy_hourly"](v).drop("loaded_at", "hour_date")


def stream_gold_energy_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir, _run(spark, sf_dir, "power", True))
    return registry.PLANS["energy_daily"](v).drop("loaded_at", "day_part")


def stream_setup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: setup runs from the hourly segments the Gold stream stores; every
    delivery brings readings of hours that others already filled."""
    return extensions.setup_runs_of(spark.read.parquet(f"{_run(spark, sf_dir, 'production', True)}/setup_segments"))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts that stand in the history after two deliveries of all
    three domains; the second changes and clears what the first raised."""
    root = scratch_path(spark, f"stream-run/alerts-{uuid.uuid4().hex}")

    def run(landing: str) -> None:
        # the streams write tables, or partitions, of their own
        side_by_side(*[partial(run_silver_stream, spark, landing, f"{root}/tables", f"{root}/checkpoints", domain)
                       for domain in VERSIONS])
        run_gold_stream(spark, f"{root}/tables", f"{root}/checkpoints")

    deliver(drops_by_key(bronze_from_events(spark, sf_dir), 2), root, run, keep=False)
    return extensions.reported_alerts(standing(alert_history(spark, f"{root}/tables")))


from millstone.streaming.event_time import stream_dedup_within_watermark, stream_hourly_tumbling  # noqa: E402

STREAM_QUERIES = {
    "run_audit": (run_audit, None),
    "run_log": (run_log, "run_log"),
    "stream_gold_energy_hourly": (stream_gold_energy_hourly, "upserted_energy_hourly"),
    "bronze_stream_ingest": (bronze_stream_ingest, "profile_by_version"),
    "stream_hourly_tumbling": (stream_hourly_tumbling, "stream_hourly_tumbling"),
    "stream_dedup_within_watermark": (stream_dedup_within_watermark, "stream_dedup_within_watermark"),
    "stream_silver_production": (stream_silver_production, "silver_production"),
    "stream_silver_vibration": (stream_silver_vibration, "silver_vibration"),
    "stream_silver_power": (stream_silver_power, "silver_power"),
    "stream_merge_insert_only": (stream_merge_insert_only, "merge_insert_only"),
    "stream_merge_upsert": (stream_merge_upsert, "merge_upsert"),
    "stream_gold_production_hourly": (stream_gold_production_hourly, "production_hourly"),
    "stream_gold_vibration_hourly": (stream_gold_vibration_hourly, "vibration_hourly"),
    "stream_setup_runs": (stream_setup_runs, "setup_runs"),
    "stream_alerts": (stream_alerts, "alerts"),
    "stream_gold_energy_daily": (stream_gold_energy_daily, "energy_daily"),
}
