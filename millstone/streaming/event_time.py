"""Event-time streaming operators (ST6, ST8).

Watermarks need an event-time column of TIMESTAMP type, so an instant
``event_time`` is derived from the NTZ ``event_ts`` through epoch micros
(UTC, whatever the session zone), and window starts go back the same way.  State is
bounded by the watermark: a 1-hour window with a 1-hour delay holds at most
two hours of groups per asset, whatever the volume.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.functions.timefn import epoch_micros, hour_start
from millstone.operators.keyed_write import table_exists, upsert
from millstone.session import scratch_path
from millstone.sources.bronze import bronze_from_events

LATENESS = "1 hour"


def time_slices(bronze: DataFrame, slices: int) -> Iterator[DataFrame]:
    """Consecutive event-time slices, as a live feed would deliver them."""
    lo, hi = bronze.agg(F.min("event_ts"), F.max("event_ts")).first()
    step = (hi - lo) / slices
    for k in range(slices):
        # boundaries as text -> NTZ (a Python datetime literal is zone-bound)
        cond = F.col("event_ts") >= F.lit(str(lo + step * k)).cast("timestamp_ntz") if k else F.lit(True)
        if k < slices - 1:
            cond = cond & (F.col("event_ts") < F.lit(str(lo + step * (k + 1))).cast("timestamp_ntz"))
        yield bronze.filter(cond)


def _production_stream(spark: SparkSession, landing: str) -> DataFrame:
    return (spark.readStream.schema(S.BRONZE).parquet(landing)
            .filter(F.col("schema_version") == S.V_PRODUCTION)
            .withColumn("event_time", F.timestamp_micros(epoch_micros("event_ts"))))


def _run_available(writer, late_allowed: bool = False) -> None:
    """One run over all that has landed: one micro-batch, whatever the number
    of its files.  Rows that came too late for the watermark are an error,
    unless another branch takes them."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if late_allowed:
        return
    late = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    if late:
        raise RuntimeError(f"{late} rows came behind the watermark")


def _ntz_from_instant(c) -> "F.Column":
    """TIMESTAMP instant -> UTC wall clock as NTZ, independent of the
    session zone (through epoch micros)."""
    us = F.unix_micros(c)
    day = F.lit(86400000000)
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.floor(us / day).cast("int"), F.lit(0), F.lit(0),
                                 ((us % day) / F.lit(1000000)).cast("decimal(18,6)")))


def remerge_late_hours(spark: SparkSession, landing: str, out: str, checkpoints: str) -> None:
    """The late branch of the tumbling count, run before the windows see what
    has landed: an hour that the watermark may have closed (it ended at least
    ``LATENESS`` before the newest counted hour) and that gets rows now is
    counted again whole from the landed messages and merged.  The hours are a
    filter on event time that reaches the Parquet scan, and a semi-join."""
    raw = spark.readStream.schema(S.BRONZE).parquet(landing).filter(F.col("schema_version") == S.V_PRODUCTION)

    def write(df: DataFrame, batch_id: int) -> None:
        if not table_exists(spark, out):
            return
        newest = spark.read.parquet(out).agg(F.max("hour_utc").cast("string")).first()[0]
        closed = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {LATENESS}")
        late = df.select("asset", hour_start("event_ts").alias("hour_utc")).filter(F.col("hour_utc") <= closed).distinct().persist()
        lo, hi = late.agg(F.min("hour_utc").cast("string"), F.max("hour_utc").cast("string")).first()
        if lo is not None:
            first, last = (F.lit(x).cast("timestamp_ntz") for x in (lo, hi))
            landed = (spark.read.schema(S.BRONZE).parquet(landing)
                      .filter((F.col("schema_version") == S.V_PRODUCTION) & (F.col("event_ts") >= first)
                              & (F.col("event_ts") < last + F.expr("INTERVAL 1 HOUR"))))
            rows = (landed.select("asset", hour_start("event_ts").alias("hour_utc"))
                    .join(late, ["asset", "hour_utc"], "left_semi").groupBy("asset", "hour_utc")
                    .agg(F.count(F.lit(1)).alias("messages")).withColumn("hour_date", F.to_date("hour_utc")))
            upsert(rows, out, ["asset", "hour_utc"], "hour_date", f"late-{batch_id}")
        late.unpersist()
    _run_available(raw.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoints}/late"))


def hourly_message_counts(spark: SparkSession, landing: str, tables: str, checkpoints: str) -> str:
    """ST8: messages per asset per event-time hour, tumbling window with a
    watermark, update mode, upserted per micro-batch; rows behind the watermark
    re-merge their hour."""
    agg = (_production_stream(spark, landing).withWatermark("event_time", LATENESS)
           .groupBy(F.window("event_time", "1 hour"), "asset")
           .agg(F.count(F.lit(1)).alias("messages")))
    out = f"{tables}/hourly_messages"
    remerge_late_hours(spark, landing, out, checkpoints)

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.select("asset", _ntz_from_instant(F.col("window.start")).alias("hour_utc"), "messages") \
            .withColumn("hour_date", F.to_date("hour_utc"))
        upsert(rows, out, ["asset", "hour_utc"], "hour_date", f"tumble-{batch_id}")
    _run_available(agg.writeStream.outputMode("update").foreachBatch(write)
                   .option("checkpointLocation", f"{checkpoints}/tumbling"), late_allowed=True)
    return out


def dedup_within_watermark(spark: SparkSession, landing: str, tables: str, checkpoints: str) -> str:
    """ST6: bounded-state, first-seen-wins duplicate removal on
    (asset, event_ts) — copies of a message arrive within the lateness."""
    d = (_production_stream(spark, landing).withWatermark("event_time", LATENESS)
         .dropDuplicatesWithinWatermark(["asset", "event_ts"]))
    out = f"{tables}/unique_messages"

    def write(df: DataFrame, batch_id: int) -> None:
        # a batch that is run again replaces its own rows
        df.select("asset", "event_ts").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    _run_available(d.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoints}/dedup"))
    return out


def _run_sliced(spark: SparkSession, sf_dir: str, run, slices: int = 4, order: list[int] | None = None) -> str:
    """Lands slice after slice (in ``order``) and runs the query over each: a
    batch is a slice by construction, whatever the parallelism of either side."""
    root = scratch_path(spark, f"stream-et/{uuid.uuid4().hex}")
    raw = bronze_from_events(spark, sf_dir).filter(F.col("schema_version") == S.V_PRODUCTION)
    parts = list(time_slices(raw, slices))
    for k in order or range(slices):
        parts[k].write.mode("append").parquet(f"{root}/landing")
        out = run(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoints")
    return out


def stream_hourly_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8 with a slice that comes after later ones."""
    out = _run_sliced(spark, sf_dir, hourly_message_counts, order=[0, 2, 1, 3])
    return spark.read.parquet(out).select("asset", "hour_utc", "messages")


def stream_dedup_within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_sliced(spark, sf_dir, dedup_within_watermark)
    return spark.read.parquet(out).select("asset", "event_ts")
