"""Commit log of the Silver streams (ST4, ST7, ST14, X11, A12, M4).

A micro-batch writes its rows below ``stream=/batch_id=`` in every sink, then
the asset-hours it touched, and last one row of the log: that row makes all of
them visible at once.  Readers go through ``visible``; what a crashed batch left
behind is neither read nor kept, because the replay of the batch overwrites it.

The log is a folder of append-only files, so it is itself a streaming source:
the offset of the Gold stream over it is the stored mark (ST7), and a refresh
sees the commits after that mark only.  A batch that is replayed after its commit
(a crash before the stream's own checkpoint) appends its row again; ``commits``
keeps the last row of each batch.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millstone.functions.timefn import hour_start
from millstone.operators.keyed_write import COMMIT, table_exists, utc_now

LOG = ("stream string, batch_id long, rows_in long, rows_written long, rows_quarantined long, "
       "committed_at timestamp_ntz")
TOUCHED = "asset string, hour_utc timestamp_ntz, messages long, stream string, batch_id long"
COMMIT_COLS = COMMIT
#: two appends to one folder would clean up each other's unfinished files
_APPEND = threading.Lock()


def log_path(tables: str) -> str:
    return f"{tables}/commit_log"


def touched_path(tables: str) -> str:
    return f"{tables}/commit_touched"


def write_touched(batch: DataFrame, tables: str, stream: str, batch_id: int) -> int:
    """The batch's (asset, hour) keys with their messages; returns the rows in."""
    keys = batch.groupBy("asset", hour_start("event_ts").alias("hour_utc")).agg(F.count(F.lit(1)).alias("messages"))
    path = f"{touched_path(tables)}/stream={stream}/batch_id={batch_id}"
    keys.write.mode("overwrite").parquet(path)
    schema = TOUCHED.split(", stream")[0]
    return batch.sparkSession.read.schema(schema).parquet(path).agg(F.coalesce(F.sum("messages"), F.lit(0))).first()[0]


def largest_slot(spark: SparkSession, tables: str, stream: str, batch_id: int, hourly: bool) -> int:
    """Most messages that the batch has for one day (``hourly``: one hour)."""
    path = f"{touched_path(tables)}/stream={stream}/batch_id={batch_id}"
    slot = F.col("hour_utc") if hourly else F.to_date("hour_utc")
    each = spark.read.schema(TOUCHED.split(", stream")[0]).parquet(path).groupBy(slot).agg(F.sum("messages").alias("n"))
    return each.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def commit(spark: SparkSession, tables: str, stream: str, batch_id: int, rows_in: int, rows_written: int,
           rows_quarantined: int) -> None:
    row = spark.createDataFrame([(stream, batch_id, rows_in, rows_written, rows_quarantined)],
                                LOG.split(", committed_at")[0])
    with _APPEND:
        row.withColumn("committed_at", utc_now()).coalesce(1).write.mode("append").parquet(log_path(tables))


def commits(spark: SparkSession, tables: str) -> DataFrame:
    """One row per committed batch: its last entry in the log."""
    if not table_exists(spark, log_path(tables)):
        return spark.createDataFrame([], LOG)
    w = Window.partitionBy(*COMMIT_COLS).orderBy(F.desc("committed_at"))
    return (spark.read.schema(LOG).parquet(log_path(tables))
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))


def last_batches(spark: SparkSession, tables: str) -> dict[str, int]:
    """Newest committed batch of each stream (batches commit in order): one
    number per stream."""
    return {r.stream: r.last for r in commits(spark, tables).groupBy("stream").agg(F.max("batch_id").alias("last")).collect()}


def visible(spark: SparkSession, tables: str, name: str) -> DataFrame:
    """Rows of a Silver table that are committed.  The condition is on
    partition columns, so files of other batches are not opened.  A table
    without commit columns (a backfill, an upsert) is read as it is."""
    df = spark.read.parquet(f"{tables}/{name}")
    if not set(COMMIT_COLS) <= set(df.columns):
        return df
    known = [(F.col("stream") == s) & (F.col("batch_id") <= b) for s, b in last_batches(spark, tables).items()]
    return df.filter(reduce(lambda a, b: a | b, known, F.lit(False))).drop(*COMMIT_COLS)


def touched_keys(spark: SparkSession, tables: str, stream: str, batch_ids: list[int]) -> DataFrame:
    """(asset, hour_utc) that these commits touched."""
    t = spark.read.schema(TOUCHED).parquet(touched_path(tables))
    return t.filter((F.col("stream") == stream) & F.col("batch_id").isin(batch_ids)).select("asset", "hour_utc").distinct()
