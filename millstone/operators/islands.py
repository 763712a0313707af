"""Gaps-and-islands: runs of consecutive readings in one state (ST10/X6).

A run starts at an in-state reading whose predecessor (same key, by time)
is not in the state; a reading's run id is the latest start at or before
it.  Everything is computed over ONE exchange on (key, hour bucket):

* inside a bucket: previous state (lag), running max of inner starts, the
  bucket's first row;
* a small per-(key, bucket) edge table decides whether each bucket's first
  row starts a run (it needs the previous bucket's last state) and carries
  the latest start from earlier buckets;
* runs are then a hash aggregate on (key, run id).

No task ever holds all readings of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millstone.functions.timefn import hour_start
from millstone.operators.sequence import _keyed

SEGMENT = ["run_start", "run_end", "readings"]


def hour_segments(df: DataFrame, key: str, ts: str, in_state, weight: str) -> DataFrame:
    """Runs cut at the hour: one row per (key, hour_utc, run inside the hour) with
    whether it holds the hour's first (``opens``) or last (``closes``) reading,
    and one row (``in_run`` false) per hour that has readings out of the state.
    A row depends on its own hour alone, so an hour that late readings touch can
    be replaced by itself."""
    src = df.select(key, ts, F.coalesce(in_state, F.lit(False)).alias("_in"), weight).withColumn("hour_utc", hour_start(ts))
    w = Window.partitionBy(key, "hour_utc").orderBy(F.col(ts).asc())
    wd = Window.partitionBy(key, "hour_utc").orderBy(F.col(ts).desc())
    starts = F.col("_in") & ~F.coalesce(F.lag("_in").over(w), F.lit(False))
    x = src.select("*", starts.cast("int").alias("_starts"), (F.row_number().over(w) == 1).alias("_first"),
                   (F.row_number().over(wd) == 1).alias("_last"))
    x = x.withColumn("_n", F.when(F.col("_in"), F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return x.groupBy(key, "hour_utc", "_n").agg(
        F.min(ts).alias("run_start"), F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("readings"),
        F.sum(weight).alias(f"{weight}_sum"), (F.bool_or("_first") & F.col("_n").isNotNull()).alias("opens"),
        (F.bool_or("_last") & F.col("_n").isNotNull()).alias("closes"),
    ).withColumn("in_run", F.col("_n").isNotNull()).drop("_n")


def stitch_segments(segments: DataFrame, key: str, weight: str) -> DataFrame:
    """Whole runs from ``hour_segments``: a segment that opens its hour goes on
    with the one that closed the last hour before it.  At most three rows of an
    hour meet in the window of a key; runs inside an hour pass by it."""
    total = f"{weight}_sum"
    inner = segments.filter("in_run and not opens and not closes").select(key, *SEGMENT, total)
    edge = segments.filter("not in_run or opens or closes").withColumn(
        "_turn", F.when(F.col("opens"), 0).when(F.col("closes"), 2).otherwise(1))
    w = Window.partitionBy(key).orderBy("hour_utc", "_turn")
    goes_on = F.col("opens") & F.coalesce(F.lag("closes").over(w), F.lit(False))
    edge = edge.withColumn("_new", (~goes_on).cast("int"))
    edge = edge.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("in_run")
    runs = edge.groupBy(key, "_run").agg(
        F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("readings").alias("readings"),
        F.sum(total).alias(total)).drop("_run")
    return runs.unionByName(inner)


def state_runs(df: DataFrame, key: str, ts: str, in_state, weight: str | None = None) -> DataFrame:
    """One row per run: key, run_start, run_end, readings[, <weight>_sum]."""
    # exactly the columns both branches use (identical subplans -> reuse)
    src = df.select(key, ts, F.coalesce(in_state, F.lit(False)).alias("_in"), *([weight] if weight else []))
    w = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).asc())
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    wd = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).desc())
    inner_start = F.col("_in") & ~F.coalesce(F.lag("_in").over(w), F.lit(True))
    x = _keyed(src, key, ts).select(
        "*", F.row_number().over(w).alias("_rn"), F.row_number().over(wd).alias("_rn_desc"),
        F.max(F.when(inner_start, F.col(ts))).over(run).alias("_inner_max"),
        F.first("_in").over(run).alias("_first_in"), F.first(ts).over(run).alias("_first_ts"))
    rest = [c for c in src.columns if c != key]
    # the edge row carries the whole last row: same columns as the row
    # branch, so both branches share one (reused) exchange
    e = x.filter(F.col("_rn_desc") == 1).select(
        "_k", "_bucket", "_inner_max", "_first_in", "_first_ts", F.struct(*rest).alias("_last"))
    wk = Window.partitionBy("_k").orderBy("_bucket")
    prev_last_in = F.lag("_last").over(wk).getField("_in")
    first_starts = F.col("_first_in") & ~F.coalesce(prev_last_in, F.lit(False))
    e = e.select("_k", "_bucket", "_inner_max", "_first_ts", first_starts.alias("_first_starts"))
    e = e.withColumn("_bucket_max", F.greatest("_inner_max", F.when(F.col("_first_starts"), F.col("_first_ts"))))
    e = e.select("_k", "_bucket", "_first_starts",
                 F.max("_bucket_max").over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    j = x.join(e, ["_k", "_bucket"], "left").filter(F.col("_in"))
    run_id = F.greatest(x["_inner_max"], F.when(F.col("_first_starts"), x["_first_ts"]), F.col("_carry"))
    j = j.withColumn("_run_id", run_id).withColumn(key, F.col("_k").getField(key))
    aggs = [F.min(ts).alias("run_start"), F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("readings")]
    if weight:
        aggs.append(F.sum(weight).alias(f"{weight}_sum"))
    return j.groupBy(key, "_run_id").agg(*aggs).drop("_run_id")
