"""Structured Streaming runners (ST1–ST14).

One streaming query per domain, each with its own checkpoint, reading the
landing folder of raw messages (file source: only new files per trigger).
Per micro-batch, ``foreachBatch`` runs the same pure Silver transform as
the backfill and a keyed write, and logs the commit; the stream offset advances
only after the batch function returns, and the writes are idempotent under
replay.  Gold is a stream of its own over the commit log (``gold_refresh``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.operators.dedup import batch_slot, latest_in_slots
from millstone.operators.keyed_write import MOVERS, insert_only, table_exists, upsert
from millstone.plans import silver
from millstone.session import shuffles_removed, side_by_side
from millstone.sources import refdata
from millstone.streaming.commits import commit, largest_slot, log_path, write_touched
from millstone.streaming.gold_refresh import run_gold_stream

PART, HOUR = "event_date", "event_hour"
#: messages that one task sorts: more would not fit its memory, and go to disk once more
TASK_ROWS = 250_000

DROP = "_drop"


def drops_by_key(bronze: DataFrame, drops: int) -> DataFrame:
    """Deal messages to ``drops`` deliveries; copies of one message (same
    asset and timestamp) share one, like a gateway that retries within one
    delivery window."""
    return bronze.withColumn(DROP, F.pmod(F.xxhash64("asset", "event_ts"), F.lit(drops)).cast("int"))


def drops_by_slot(bronze: DataFrame) -> DataFrame:
    """Deal messages so that every later ingest slot of a key is a later
    delivery: the k-th drop holds each key's k-th slot.  Keys do not touch
    each other, so merging the drops in turn leaves the table that one merge
    per 15-minute slot would."""
    w = Window.partitionBy("schema_version", "asset", "event_ts").orderBy(batch_slot())
    return bronze.withColumn(DROP, F.dense_rank().over(w) - 1)


def deliver(dropped: DataFrame, root: str, run, keep: bool = True) -> None:
    """Land one drop after the other and ``run`` the stream over each: all
    files that a drop adds are one micro-batch, whatever their number.  The files
    are moved, so that a message lies on disk once; those that the stream has
    committed may be dropped from the landing folder (``keep``)."""
    spark = dropped.sparkSession
    with shuffles_removed(spark):
        dropped.write.option("compression", "zstd").partitionBy(DROP).parquet(f"{root}/outbox")
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        drops = [s.getPath().getName() for s in fs.listStatus(at(f"{root}/outbox")) if s.isDirectory()]
        fs.mkdirs(at(f"{root}/landing"))
        for drop in sorted((d for d in drops if d.startswith(f"{DROP}=")), key=lambda d: int(d.split("=")[1])):
            k = drop.split("=")[1]

            def land(name: str) -> str:
                # files of different drops may have one name
                landed = f"{root}/landing/{k}-{name}"
                if not fs.rename(at(f"{root}/outbox/{drop}/{name}"), at(landed)):
                    raise RuntimeError(f"{landed} could not be landed")
                return landed

            with ThreadPoolExecutor(MOVERS) as pool:
                names = [s.getPath().getName() for s in fs.listStatus(at(f"{root}/outbox/{drop}"))]
                landed = list(pool.map(land, [n for n in names if n.endswith(".parquet")]))
            run(f"{root}/landing")
            if not keep:
                with ThreadPoolExecutor(MOVERS) as pool:
                    list(pool.map(lambda f: fs.delete(at(f), False), landed))


def _landed(spark: SparkSession, landing: str, max_bytes: str | None) -> DataFrame:
    """Stream over the landing folder; a micro-batch takes what is new, or
    about ``max_bytes`` of it where the backlog is larger than one batch
    should be."""
    reader = spark.readStream.schema(S.BRONZE)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(landing)


def ingest_files(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                 max_bytes: str | None = None) -> None:
    """A5: append the landed raw files to the Bronze table.  The checkpoint
    records which files were loaded (and the file sink's log which output
    was committed), so a rerun loads only files it has not seen."""
    (_landed(spark, landing, max_bytes)
        .writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination())


def _with_part(df: DataFrame) -> DataFrame:
    return df.withColumn(PART, F.to_date("event_ts"))


def silver_batch(domain: str, tables: str, strict_reference: bool = False):
    """The foreachBatch body for one domain.  All sinks are written below the
    batch's own partitions; the commit row, written last, makes them visible
    together (A12, M4).  Power is upserted in place: its replay republishes the
    same hours."""
    def run(batch: DataFrame, batch_id: int) -> None:
        # the batch is read from its files by each sink: held in memory, the text of
        # one compressed split would be read back as gigabytes by one task
        spark = batch.sparkSession
        sink = partial(insert_only, key="event_id", partition_col=PART, commit=(domain, batch_id))
        rows_in = write_touched(batch, tables, domain, batch_id)
        largest = largest_slot(spark, tables, domain, batch_id, hourly=domain == "power")
        slots = [F.to_date("event_ts"), *([F.hour("event_ts")] if domain == "power" else [])]
        dedup = latest_in_slots(slots, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows_in // TASK_ROWS)),
                                -(-largest // TASK_ROWS))

        def events() -> int:
            if domain == "vibration":
                out = silver.silver_vibration(silver.route_vibration(batch), dedup)
                return sink(_with_part(out), f"{tables}/vibration_events", placed=True)
            if domain == "production":
                out = silver.silver_production(batch, refdata.machine_config(spark), strict_reference, dedup)
                return sink(_with_part(out), f"{tables}/production_events", placed=True)
            power = _with_part(silver.silver_power(batch, dedup)).withColumn(HOUR, F.hour("event_ts"))
            return upsert(power, f"{tables}/power_events", ["event_id"], [PART, HOUR], f"power-{batch_id}", placed=True)

        def rejects() -> int:
            if domain == "vibration":
                out, name = silver.silver_quarantine(silver.route_vibration(batch)), "vibration_quarantine"
            else:
                out, name = silver.silver_unparsable(batch), "message_quarantine"
            return sink(_with_part(out), f"{tables}/{name}")

        # the sinks share nothing but the batch's files
        written, rejected = side_by_side(events, rejects)
        commit(spark, tables, domain, batch_id, rows_in, written, rejected)
    return run


def run_silver_stream(spark: SparkSession, landing: str, tables: str, checkpoints: str, domain: str,
                      max_bytes: str | None = None, available_now: bool = True, processing_time: str = "15 minutes"):
    versions = {"production": [S.V_PRODUCTION], "vibration": list(S.VIBRATION_VERSIONS), "power": [S.V_POWER]}[domain]
    raw = (_landed(spark, landing, max_bytes)
           .filter(F.col("schema_version").isin(*versions)))
    w = raw.writeStream.foreachBatch(silver_batch(domain, tables)) \
        .option("checkpointLocation", f"{checkpoints}/silver_{domain}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_pipeline_stream(spark: SparkSession, landing: str, tables: str, checkpoints: str, domain: str,
                        max_bytes: str | None = None) -> None:
    """What has landed into Silver, then what was committed into Gold."""
    run_silver_stream(spark, landing, tables, checkpoints, domain, max_bytes)
    if table_exists(spark, log_path(tables)):
        run_gold_stream(spark, tables, checkpoints)
