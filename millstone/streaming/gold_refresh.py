"""Gold from commits: only touched asset-hours are recomputed (ST3, ST11, T3).

The Gold stream reads the commit log.  For the commits after its offset it takes
the touched (asset, hour) keys, reads the Silver days they lie in (a partition
filter) and of these only the touched hours, recomputes those hours whole, and
merges them with the stored rows of the same days.  Replaying a refresh gives the
same tables.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.functions.timefn import day_of, hour_start, to_local
from millstone.operators.keyed_write import (
    _in_partitions, _null_safe_on, in_slots, overwrite_partitions, table_exists, touched_slots, touched_values, utc_now)
from millstone.operators.rolling import rolling_rows, rolling_time
from millstone.plans import extensions, gold
from millstone.session import scratch_path, side_by_side
from millstone.sources import refdata
from millstone.streaming.alert_history import append_alerts
from millstone.streaming.commits import LOG, log_path, touched_keys, visible

PART, HOUR = "event_date", "event_hour"
GOLD_PART = "hour_date"
KEYS = ["asset", "hour_utc"]
ROLLING = ["rolling_7day_avg_rms", "rolling_7d_time_avg_rms"]


def touched_silver(spark: SparkSession, tables: str, name: str, touched: DataFrame, days: list) -> DataFrame:
    """Rows of the touched hours, from the days (in an hourly table: the
    hours) they lie in."""
    s = visible(spark, tables, name)
    if HOUR in s.columns:
        slots = touched_slots(touched.select(F.to_date("hour_utc").alias(PART), F.hour("hour_utc").alias(HOUR)), [PART, HOUR])
        s = s.filter(in_slots([PART, HOUR], slots))
    else:
        s = s.filter(_in_partitions(PART, days))
    s = s.withColumn("_hour", hour_start("event_ts"))
    on = s["asset"].eqNullSafe(touched["asset"]) & s["_hour"].eqNullSafe(touched["hour_utc"])
    return s.join(touched, on, "left_semi").drop("_hour")


def untouched_gold(spark: SparkSession, path: str, touched: DataFrame, days: list | None, like: DataFrame) -> DataFrame:
    """Stored rows of these days (all days if None) that no commit touched."""
    if not table_exists(spark, path):
        return like.limit(0)
    old = spark.read.schema(like.schema).parquet(path)
    if days is not None:
        old = old.filter(_in_partitions(GOLD_PART, days))
    return old.join(touched, _null_safe_on(old, touched, KEYS), "left_anti").select(*like.columns)


def _merge_hours(fresh: DataFrame, path: str, touched: DataFrame, days: list) -> None:
    fresh = fresh.withColumn(GOLD_PART, F.to_date("hour_utc")).withColumn("loaded_at", utc_now())
    overwrite_partitions(fresh.unionByName(untouched_gold(fresh.sparkSession, path, touched, days, fresh)), path, GOLD_PART)


def refresh_production(spark: SparkSession, tables: str, touched: DataFrame, days: list) -> None:
    """Hourly production, and the setup runs cut at the hour (ST10): a run that
    spans hours, batches or late rows is whole again once they are stitched."""
    s = touched_silver(spark, tables, "production_events", touched, days)
    hourly, runs = gold.production_hourly(s, refdata.machine_config(spark)), extensions.setup_segments(s)
    side_by_side(lambda: _merge_hours(hourly, f"{tables}/production_hourly", touched, days),
                 lambda: _merge_hours(runs, f"{tables}/setup_segments", touched, days))


def refresh_power(spark: SparkSession, tables: str, touched: DataFrame, days: list) -> None:
    """The touched hours, then the local days that hold them, from hourly rows."""
    s = touched_silver(spark, tables, "power_events", touched, days)
    hourly = f"{tables}/energy_hourly"
    _merge_hours(gold.energy_hourly(s), hourly, touched, days)
    local = touched.select(day_of(to_local("hour_utc")).alias("day_local")).distinct()
    # a local day lies in two UTC days at most
    around = touched_values(local.select(F.explode(F.array(F.date_sub("day_local", 1), "day_local")).alias("d")), "d")
    h = spark.read.parquet(hourly).filter(_in_partitions(GOLD_PART, around)).drop(GOLD_PART, "loaded_at")
    h = h.join(local, day_of("hour_local") == local["day_local"], "left_semi")
    daily = gold.energy_daily(h).withColumn("day_part", F.col("day_local")).withColumn("loaded_at", utc_now())
    overwrite_partitions(daily, f"{tables}/energy_daily", "day_part")


def refresh_vibration(spark: SparkSession, tables: str, touched: DataFrame, days: list) -> None:
    """A late hour changes its own row and the rolling means of the 167 rows
    behind it.  The means are recomputed on the hourly table alone, and only
    days in which a row changed are written."""
    path = f"{tables}/vibration_hourly"
    s = touched_silver(spark, tables, "vibration_events", touched, days)
    fresh = gold.vibration_hourly(s).drop(*ROLLING)
    rows = fresh.unionByName(untouched_gold(spark, path, touched, None, fresh))
    rolled = (rows.withColumn(ROLLING[0], rolling_rows("avg_rms_velocity"))
              .withColumn(ROLLING[1], rolling_time("avg_rms_velocity")).withColumn(GOLD_PART, F.to_date("hour_utc")))
    stage = scratch_path(spark, f"staging/gold/{uuid.uuid4().hex}")
    rolled.write.parquet(stage)
    rolled = spark.read.schema(rolled.schema).parquet(stage)
    changed = rolled
    if table_exists(spark, path):
        old = spark.read.parquet(path).select(*KEYS, *[F.col(c).alias(f"_{c}") for c in ROLLING], F.lit(True).alias("_old"))
        new = rolled.select(*KEYS, *ROLLING, GOLD_PART)
        j = new.join(old, _null_safe_on(new, old, KEYS), "left")
        same = [new[c].eqNullSafe(j[f"_{c}"]) for c in ROLLING]
        moved = j.filter(F.col("_old").isNull() | ~(same[0] & same[1])).select(GOLD_PART)
        dates = touched_values(moved.union(touched.select(F.to_date("hour_utc"))), GOLD_PART)
        changed = rolled.filter(_in_partitions(GOLD_PART, dates))
    overwrite_partitions(changed.withColumn("loaded_at", utc_now()), path, GOLD_PART)


REFRESH = {"production": refresh_production, "vibration": refresh_vibration, "power": refresh_power}


def refresh_commits(tables: str):
    """foreachBatch body over the commit log."""
    def run(log: DataFrame, refresh_id: int) -> None:
        spark = log.sparkSession
        new: dict[str, list[int]] = {}
        for r in log.select("stream", "batch_id").distinct().collect():      # one row per commit
            new.setdefault(r.stream, []).append(r.batch_id)

        def refresh(stream: str, ids: list[int]) -> None:
            touched = touched_keys(spark, tables, stream, ids).persist()
            days = touched_values(touched.select(F.to_date("hour_utc").alias("d")), "d")
            if days:
                REFRESH[stream](spark, tables, touched, days)
                append_alerts(spark, tables, stream, touched, days, refresh_id)
            touched.unpersist()
        if new:                                  # each stream has tables, and partitions of the history, of its own
            side_by_side(*[partial(refresh, stream, ids) for stream, ids in sorted(new.items())])
    return run


def run_gold_stream(spark: SparkSession, tables: str, checkpoints: str, available_now: bool = True,
                    processing_time: str = "1 hour"):
    """ST3: Gold on its own schedule, from the commits after its offset."""
    w = (spark.readStream.schema(LOG).parquet(log_path(tables)).writeStream.foreachBatch(refresh_commits(tables))
         .option("checkpointLocation", f"{checkpoints}/gold"))
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
    if available_now:
        q.awaitTermination()
    return q
