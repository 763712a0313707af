"""One-time backfill with the same transforms as the streams (ST13).

Raw messages are landed once as a Parquet table partitioned by
``schema_version`` (the discriminator becomes partition pruning), Silver is
written partitioned by event date, Gold is built from the written Silver.
The vibration split (events + quarantine) reads one persisted routing pass.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.plans import gold, silver
from millstone.plans.catalog import Pipeline


def land_raw(bronze: DataFrame, path: str) -> None:
    bronze.write.mode("overwrite").partitionBy("schema_version").parquet(path)


def _write(df: DataFrame, path: str, part: str = "event_date", col: str = "event_ts",
           one_file_per_day: bool = False) -> None:
    out = df.withColumn(part, F.to_date(col))
    if one_file_per_day:
        # Gold only: a day of Gold is at most assets x 24 rows, so one task
        # per day is bounded whatever the raw volume
        out = out.repartition(part)
    else:
        # ranges of (day, asset, time): a day is cut into as many files as its
        # share of the rows, not into one per task
        out = out.repartitionByRange(part, "asset", col)
    # clustered layout (asset, time) inside each date folder: the writer
    # sorts by the partition column anyway; asset-ordered row groups let
    # per-asset reads skip by min/max statistics
    out = out.sortWithinPartitions(part, "asset", col)
    out.write.mode("overwrite").partitionBy(part).parquet(path)


def write_silver(p: Pipeline, out: str) -> None:
    _write(p.production_events, f"{out}/production_events")
    routed = p.vibration_routed.persist(StorageLevel.MEMORY_AND_DISK)
    _write(silver.silver_vibration(routed), f"{out}/vibration_events")
    _write(silver.silver_quarantine(routed), f"{out}/vibration_quarantine")
    routed.unpersist()
    _write(p.power_events, f"{out}/power_events")
    _write(silver.silver_unparsable(p.bronze), f"{out}/message_quarantine")


def write_gold(spark: SparkSession, p: Pipeline, out: str) -> None:
    """``p`` reads the written Silver tables (``tables_dir``)."""
    _write(gold.production_hourly(p.production_events, p.machine_config), f"{out}/production_hourly",
           "hour_date", "hour_utc", True)
    _write(gold.vibration_hourly(p.vibration_events), f"{out}/vibration_hourly", "hour_date", "hour_utc", True)
    _write(gold.energy_hourly(p.power_events), f"{out}/energy_hourly", "hour_date", "hour_utc", True)
    eh = spark.read.parquet(f"{out}/energy_hourly").drop("hour_date")
    _write(gold.energy_daily(eh), f"{out}/energy_daily", "day_part", "day_local", True)
