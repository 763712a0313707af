"""Domain classifiers: pure ``Column -> Column`` CASE rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millstone.functions.timefn import iso_dow, minute_of_day
from millstone.sources import refdata

# Fixed values -------------------------------------------------------------
STATE_PRODUCTIVE, STATE_PLANNED, STATE_STOPPED = 800, 801, 803
STATUS_NO_ORDER = 803105
ZONE_BOUNDS = (1.8, 4.5, 11.2)      # ISO 10816 class II, mm/s RMS
RPM_RUNNING, RPM_MOVING = 100, 0
SPARSE_MAX_KEYS = 5
LOW_PF = 0.85
PF_ALERT = 0.90
UPTIME_GOOD, UPTIME_WARN = 70.0, 50.0
# --------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def payload_format(has_3s: Column, has_60s: Column) -> Column:
    """K1: which production layout a message uses."""
    return F.when(has_3s, "3s").when(has_60s, "60s").otherwise("unknown")


def source_period_sec(period_text) -> Column:
    """K2: '60s' (or anything containing 60) -> 60, else 3."""
    return F.when(F.coalesce(_c(period_text).ilike("%60%"), F.lit(False)), 60).otherwise(3).cast("long")


def downtime_category(state, status) -> Column:
    """K4: ISA-95 style downtime class of a production reading."""
    s, st = _c(state), _c(status)
    return (F.when(s == STATE_PRODUCTIVE, "PRODUCTIVE")
             .when(s == STATE_PLANNED, "PLANNED_STOP")
             .when((s == STATE_STOPPED) & (st == STATUS_NO_ORDER), "EXCLUDED")
             .when(s == STATE_STOPPED, "UNPLANNED_DOWNTIME")
             .otherwise("UNKNOWN"))


def is_producing(state, delta, category) -> Column:
    """K5: running, parts moving, and not a machine whose counter never moves."""
    return F.coalesce((_c(state) == STATE_PRODUCTIVE) & (F.coalesce(_c(delta), F.lit(0)) > 0)
                      & (_c(category) != "ALWAYS_RUNNING"), F.lit(False))


def quarantine_reason(quality, n_keys) -> Column:
    """K6 (+ UNROUTABLE for rows that fit neither table)."""
    bad = F.coalesce(_c(quality) == "BAD", F.lit(False))
    sparse = F.coalesce(_c(n_keys) <= SPARSE_MAX_KEYS, F.lit(False))
    return (F.when(bad & sparse, "SPARSE_PAYLOAD")
             .when(bad, "QUALITY_BAD")
             .when(sparse, "SPARSE_PAYLOAD")
             .otherwise("UNROUTABLE"))


def motor_state(available, rpm) -> Column:
    """K7."""
    return (F.when(_c(available) == F.lit(False), "OFFLINE")
             .when(_c(rpm) > RPM_RUNNING, "RUNNING")
             .when(_c(rpm) > RPM_MOVING, "STARTING_STOPPING")
             .otherwise("IDLE"))


def iso_zone(rms) -> Column:
    """K8: half-open bounds, 11.2 belongs to D."""
    r = _c(rms)
    a, b, c = ZONE_BOUNDS
    return (F.when(r.isNull(), F.lit(None).cast("string"))
             .when(r < a, "A").when(r < b, "B").when(r < c, "C").otherwise("D"))


def shift_name(ts_local) -> Column:
    """K9: shift of a local timestamp by minute of day, half-open."""
    m = minute_of_day(ts_local)
    inside = [(name, (m >= lo) & (m < hi)) for _, name, _, _, lo, hi, wraps, _ in refdata.SHIFTS if not wraps]
    wrapping = next(name for _, name, *_, wraps, _ in refdata.SHIFTS if wraps)
    expr = F
    for name, cond in inside:
        expr = expr.when(cond, name)
    return expr.otherwise(wrapping)


def is_peak_hour(ts_local) -> Column:
    """Mon–Fri and local hour 9..21."""
    d, h = iso_dow(ts_local), F.hour(_c(ts_local))
    return d.between(1, 5) & h.between(9, 21)


def is_weekend(ts_local) -> Column:
    """K12."""
    return iso_dow(ts_local).isin(6, 7)


def is_anomalous_meter(asset) -> Column:
    """The meter wired in parallel with the main board."""
    return F.coalesce(_c(asset) == refdata.ANOMALOUS_METER, F.lit(False))


def traffic_light(value, good, warn, higher_is_better: bool = True) -> Column:
    """Good / warn / bad, direction aware (NULL value -> bad)."""
    v = _c(value)
    if higher_is_better:
        return F.when(v >= good, "good").when(v >= warn, "warn").otherwise("bad")
    return F.when(v <= good, "good").when(v <= warn, "warn").otherwise("bad")


def zone_status(zone) -> Column:
    """ISO zone -> traffic light: A/B good, C warn, D (or unknown) bad."""
    z = _c(zone)
    return F.when(z.isin("A", "B"), "good").when(z == "C", "warn").otherwise("bad")


def plant_status(prod_status, vib_status) -> Column:
    """Energy is not part of the plant light."""
    p, v = _c(prod_status), _c(vib_status)
    return (F.when((p == "bad") | (v == "bad"), "bad")
             .when((p == "warn") | (v == "warn"), "warn")
             .otherwise("good"))


def top_of(counts: dict) -> Column:
    """Arg-max over named count columns with a fixed ``>=`` tie order (first
    listed wins ties); NULL when every count is 0."""
    names = list(counts)
    cols = [_c(counts[n]) for n in names]
    e = F.lit(None).cast("string")
    expr = None
    for i, n in enumerate(names):
        cond = F.lit(True)
        for j in range(i + 1, len(names)):
            cond = cond & (cols[i] >= cols[j])
        expr = F.when(cond, n) if expr is None else expr.when(cond, n)
    allzero = F.lit(True)
    for c in cols:
        allzero = allzero & (F.coalesce(c, F.lit(0)) == 0)
    return F.when(allzero, e).otherwise(expr.otherwise(names[-1]))
