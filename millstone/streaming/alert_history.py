"""Alert history as a stored table (X1): what a Gold refresh changed.

A refresh compares the alerts of the hours it recomputed with those that stand
in the history and appends one row per difference: ``raised``, ``changed`` (value
or severity) or ``cleared`` (late rows took the alert back).  Rows lie below the
refresh that wrote them, and a refresh looks at earlier ones only: its replay
overwrites its own rows and adds none.  The alerts that stand are the last row of
each (rule, asset, hour) that was not cleared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.operators.keyed_write import _in_partitions, _null_safe_on, overwrite_partitions, table_exists, utc_now
from millstone.plans import extensions as X

PART = "hour_date"
KEYS = ["rule", "asset", "hour_utc"]
HISTORY = ("rule string, asset string, hour_utc timestamp_ntz, value double, severity string, action string, "
           "recorded_at timestamp_ntz, hour_date date, stream string, refresh_id long")
#: the Gold table of a stream, and its rules
RULES = {"production": ("production_hourly", X.uptime_alerts), "vibration": ("vibration_hourly", X.zone_alerts),
         "power": ("energy_hourly", X.power_factor_alerts)}


def history_path(tables: str) -> str:
    return f"{tables}/alert_history"


def alert_history(spark: SparkSession, tables: str) -> DataFrame:
    if not table_exists(spark, history_path(tables)):
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(history_path(tables))


def standing(history: DataFrame) -> DataFrame:
    """(rule, asset, hour_utc, value, severity) of the alerts that stand."""
    last = history.groupBy(*KEYS).agg(F.max_by(F.struct("value", "severity", "action"), "refresh_id").alias("last"))
    return last.filter("last.action <> 'cleared'").select(*KEYS, "last.value", "last.severity")


def append_alerts(spark: SparkSession, tables: str, stream: str, touched: DataFrame, days: list, refresh_id: int) -> None:
    """Appends what the refresh changed in the touched (asset, hour_utc)."""
    name, rules = RULES[stream]

    def of_touched(df: DataFrame) -> DataFrame:
        df = df.filter(_in_partitions(PART, days))
        return df.join(touched, _null_safe_on(df, touched, ["asset", "hour_utc"]), "left_semi")

    now = rules(of_touched(spark.read.parquet(f"{tables}/{name}"))).withColumn("_now", F.lit(True))
    earlier = alert_history(spark, tables).filter((F.col("stream") == stream) & (F.col("refresh_id") < refresh_id))
    was = standing(of_touched(earlier)).withColumn("_was", F.lit(True))
    j = now.alias("n").join(was.alias("w"), _null_safe_on(now, was, KEYS), "full_outer")
    same = F.col("n.value").eqNullSafe(F.col("w.value")) & F.col("n.severity").eqNullSafe(F.col("w.severity"))
    action = (F.when(F.col("_was").isNull(), "raised").when(F.col("_now").isNull(), "cleared")
              .when(~same, "changed"))
    now_or_was = [F.when(F.col("_now"), F.col(f"n.{c}")).otherwise(F.col(f"w.{c}")).alias(c) for c in [*KEYS, "value", "severity"]]
    rows = j.select(*now_or_was, action.alias("action")).filter("action is not null").select(
        "*", utc_now().alias("recorded_at"), F.to_date("hour_utc").alias(PART), F.lit(stream).alias("stream"),
        F.lit(refresh_id).cast("long").alias("refresh_id"))
    overwrite_partitions(rows, history_path(tables), PART, "stream", "refresh_id")
