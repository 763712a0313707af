"""Previous-row access per key without a per-key partition (W7 at scale).

``lag(x) OVER (PARTITION BY asset ORDER BY ts)`` puts every reading of an
asset into one task; an asset holding a third of the data would become one
giant task.  Here the window partition is (key, hour bucket): the first
row of each bucket takes its predecessor from a small per-bucket edge table
(one row per key-hour), which is itself windowed per key (bounded by the
number of hours).  The big side keeps its (key, bucket) hash partitioning,
so joining the edges back only shuffles the small side; the input feeds
both branches through one explicit (reused) exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millstone.functions.timefn import hour_start


def _keyed(df: DataFrame, key: str, ts: str) -> DataFrame:
    # ``struct(key)`` is never NULL, so no ``isnotnull`` filter is inferred on
    # one branch only (that would make the two input branches differ and
    # defeat exchange reuse); NULL keys still form their own sequence.
    # The raw key column is dropped (restored from _k afterwards) and the
    # edge rows carry every input column, so both branches read exactly the
    # same columns through the same exchange.
    return (df.withColumn("_k", F.struct(F.col(key))).withColumn("_bucket", hour_start(ts)).drop(key)
              .repartition("_k", "_bucket"))


def with_previous(df: DataFrame, key: str, ts: str, cols: list[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<ts>`` and ``prev_<c>`` = values of the preceding row of
    the same ``key`` ordered by ``ts`` (NULL for the first row)."""
    fields = [ts] + [c for c in cols if c != ts]
    w = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).asc())
    wd = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).desc())
    # one explicit exchange feeds both the row branch and the edge branch
    # (it is reused, so the input is computed once)
    x = _keyed(df, key, ts).select(
        "*", F.row_number().over(w).alias("_rn"), F.row_number().over(wd).alias("_rn_desc"),
        *[F.lag(c).over(w).alias(f"_in_{c}") for c in fields])
    rest = [c for c in df.columns if c != key]
    last = x.filter(F.col("_rn_desc") == 1).select("_k", "_bucket", F.struct(*rest).alias("_last"))
    we = Window.partitionBy("_k").orderBy("_bucket")
    edges = last.select("_k", "_bucket", F.lag("_last").over(we).alias("_edge"))
    j = x.join(edges, ["_k", "_bucket"], "left")
    out = j.select("*", *[F.when(F.col("_rn") == 1, F.col(f"_edge.{c}")).otherwise(F.col(f"_in_{c}"))
                          .alias(f"{prefix}{c}") for c in fields])
    out = out.withColumn(key, F.col("_k").getField(key))
    return out.drop("_k", "_bucket", "_rn", "_rn_desc", "_edge", *[f"_in_{c}" for c in fields])


def running_max(df: DataFrame, key: str, ts: str, col: str, out: str) -> DataFrame:
    """``max(col) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED
    PRECEDING)`` computed per (key, hour bucket) plus a carry from earlier
    buckets (small per-bucket edge table), so no task holds a whole key."""
    w = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).asc()).rowsBetween(Window.unboundedPreceding, 0)
    wd = Window.partitionBy("_k", "_bucket").orderBy(F.col(ts).desc())
    x = _keyed(df, key, ts).select("*", F.max(col).over(w).alias("_rm_in"),
                                   F.row_number().over(wd).alias("_rn_desc"))
    # the last row of a bucket carries the bucket's running max
    rest = [c for c in df.columns if c != key]
    edges = x.filter(F.col("_rn_desc") == 1).select("_k", "_bucket", F.col("_rm_in").alias("_bmax"),
                                                    F.struct(*rest).alias("_all"))
    we = Window.partitionBy("_k").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("_k", "_bucket", F.max("_bmax").over(we).alias("_carry"),
                         F.lag("_all").over(Window.partitionBy("_k").orderBy("_bucket")).alias("_prev_all"))
    j = x.join(edges, ["_k", "_bucket"], "left")
    j = j.withColumn(out, F.greatest("_rm_in", "_carry")).withColumn(key, F.col("_k").getField(key))
    return j.drop("_k", "_bucket", "_rm_in", "_rn_desc", "_carry", "_prev_all")
