"""Reference (dimension) tables.

These are fixed, plant-defined lookup tables — a few dozen rows that do not
grow with the telemetry — so they are always joined with an explicit
``broadcast`` hint.  ``minute_calendar`` has exactly 1,440 rows (one per
minute of the day) and ``hour_of_week`` exactly 168.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the plant's definitions for the KPIs to match).
# ---------------------------------------------------------------------------

# Shift schedule, local time GMT+7: (shift_id, name, start, end, start_min,
# end_min, crosses_midnight, duration_hours)
SHIFTS = [
    (1, "Day", "00:45:00", "09:45:00", 45, 585, False, 9.0),
    (2, "Day OT", "09:45:00", "12:45:00", 585, 765, False, 3.0),
    (3, "Night", "12:45:00", "21:45:00", 765, 1305, False, 9.0),
    (4, "Night OT", "21:45:00", "00:45:00", 1305, 45, True, 3.0),
]

# Status code -> downtime reason: (status_code, state_code, downtime_category,
# reason_name, is_countable_dt, sort_order)
REASONS = [
    (800000, 800, "PRODUCTIVE", "Running", False, 1),
    (801000, 801, "PLANNED_STOP", "Setup / Changeover", True, 2),
    (803105, 803, "EXCLUDED", "No Order Assigned", False, 3),
    (803101, 803, "UNPLANNED_DOWNTIME", "Material Shortage", True, 4),
    (803112, 803, "UNPLANNED_DOWNTIME", "Mechanical Fault", True, 5),
    (803102, 803, "UNPLANNED_DOWNTIME", "Unknown Stop (102)", True, 6),
    (803103, 803, "UNPLANNED_DOWNTIME", "Unknown Stop (103)", True, 7),
    (803104, 803, "UNPLANNED_DOWNTIME", "Unknown Stop (104)", True, 8),
    (803111, 803, "UNPLANNED_DOWNTIME", "Unknown Stop (111)", True, 9),
    (None, None, "UNKNOWN", "Offline / No Data", False, 10),
]

# Forming machines per group; always-running machines report state 800 with
# a part counter that never moves.
MACHINE_GROUPS = {
    "Group1": ["FM13", "FM14", "FM15", "FM16", "FM17", "FM19", "FM37", "FM42",
               "FM46", "FM47", "FM56", "FM57", "FM58"],
    "Group2": ["FM11", "FM12", "FM20", "FM22", "FM44", "FM45", "FM48", "FM52",
               "FM59", "FM60", "FM61"],
    "Group3": ["FM24", "FM25", "FM27", "FM51", "FM54", "FM55"],
    "Group4": ["FM21", "FM28", "FM29", "FM30", "FM31", "FM32", "FM50", "FM53"],
}
ALWAYS_RUNNING = ["FM44", "FM48", "FM51"]

# Time-of-use tariff (baht per kWh): peak Mon–Fri 09:00–21:59 local.
# (period_name, is_peak, hour_start, hour_end, applies_weekday,
#  applies_weekend, rate).  The last row covers weekend 09–22 at the off-peak
# rate.
PEAK_RATE = 4.50
OFFPEAK_RATE = 2.60
TARIFF = [
    ("Peak", True, 9, 22, True, False, PEAK_RATE),
    ("Off-Peak", False, 0, 9, True, True, OFFPEAK_RATE),
    ("Off-Peak", False, 22, 24, True, True, OFFPEAK_RATE),
    ("Off-Peak", False, 9, 22, False, True, OFFPEAK_RATE),
]

LOCAL_TZ = "Asia/Bangkok"
ANOMALOUS_METER = "PM-F3"
MAIN_METER = "MAIN-MDB"

# ---------------------------------------------------------------------------


def shift_definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SHIFTS,
        "shift_id long, shift_name string, start_time_local string, end_time_local string, "
        "start_min int, end_min int, crosses_midnight boolean, duration_hours double")


def reason_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        REASONS,
        "status_code long, state_code long, downtime_category string, reason_name string, "
        "is_countable_dt boolean, sort_order long")


def machine_config(spark: SparkSession) -> DataFrame:
    rows = []
    for g, assets in MACHINE_GROUPS.items():
        for a in assets:
            ar = a in ALWAYS_RUNNING
            rows.append((a, g, int(g[-1]), "ALWAYS_RUNNING" if ar else "ACTIVE_PRODUCER",
                         ar))
    return spark.createDataFrame(
        rows, "asset string, machine_group string, group_number long, machine_category string, "
              "is_always_running boolean")


def energy_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        TARIFF, "period_name string, is_peak boolean, hour_start int, hour_end int, "
                "applies_weekday boolean, applies_weekend boolean, rate_baht_per_kwh double")


def minute_calendar(spark: SparkSession) -> DataFrame:
    """1,440 rows: minute_of_day -> shift (half-open intervals, Night OT wraps
    midnight).  Built from the shift table by an interval rule so a range
    lookup becomes an equi-join on minute_of_day."""
    m = spark.range(0, 1440).select(F.col("id").cast("int").alias("minute_of_day"))
    s = shift_definitions(spark)
    inside = F.when(~F.col("crosses_midnight"),
                    (F.col("minute_of_day") >= F.col("start_min")) & (F.col("minute_of_day") < F.col("end_min"))) \
        .otherwise((F.col("minute_of_day") >= F.col("start_min")) | (F.col("minute_of_day") < F.col("end_min")))
    # 1,440 x 4 rows: a fixed-size lookup build, not a data join.
    return (m.join(F.broadcast(s), inside, "inner")
             .select("minute_of_day", "shift_id", "shift_name"))


def hour_of_week(spark: SparkSession) -> DataFrame:
    """168 rows (ISO day 1..7 x local hour 0..23) -> tariff band, built from
    the tariff table.  Used to prove every hour-of-week has one rate."""
    h = (spark.range(0, 168)
         .select((F.col("id") / 24).cast("int").alias("d"), (F.col("id") % 24).cast("int").alias("hour_local"))
         .select((F.col("d") + 1).alias("day_of_week"), "hour_local"))
    t = energy_rates(spark)
    weekend = F.col("day_of_week").isin(6, 7)
    cond = ((F.col("hour_local") >= F.col("hour_start")) & (F.col("hour_local") < F.col("hour_end"))
            & F.when(weekend, F.col("applies_weekend")).otherwise(F.col("applies_weekday")))
    return h.join(F.broadcast(t), cond, "left").select(
        "day_of_week", "hour_local", "period_name", "is_peak", "rate_baht_per_kwh")
