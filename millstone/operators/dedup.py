"""Latest-record-wins deduplication.

``row_number() OVER (PARTITION BY key ORDER BY ingested DESC NULLS LAST,
tiebreak DESC) = 1``.  Spark plans this as a partial WindowGroupLimit on the
map side, one hash exchange on the full key, then the final limit — so only
one row per key per map partition crosses the shuffle.  The key always
includes the event timestamp, so even an asset holding a third of all rows
spreads over every reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstone.functions.timefn import epoch_micros


def latest_per_key(df: DataFrame, keys: list[str], order_col: str = "ingested_ts",
                   tiebreak: str | None = "_tiebreak") -> DataFrame:
    order = [F.col(order_col).desc_nulls_last()]
    if tiebreak:
        order.append(F.col(tiebreak).desc_nulls_last())
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(tiebreak) if tiebreak and tiebreak in df.columns else out


def latest_in_slots(slots: list[Column], tasks: int, buckets: int = 1):
    """``latest_per_key`` for rows that are written by ``slots`` (functions of
    the keys, like the day of an event time): rows meet by slot, so the exchange
    of the deduplication is that of the write as well.  A slot of many rows
    is cut into ``buckets`` by the key."""
    def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
        at = {f"_slot{k}": c for k, c in enumerate(slots)}
        if buckets > 1:
            at["_bucket"] = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        return latest_per_key(df.withColumns(at).repartition(tasks, *at), [*at, *keys]).drop(*at)
    return dedup


def batch_slot(ingested: str = "ingested_ts", fallback: str = "event_ts",
               every_us: int = 900_000_000) -> Column:
    """Micro-batch a delivery lands in: its 15-minute ingest slot.  A delivery
    without an ingest time is taken to arrive with its event time."""
    return F.floor(epoch_micros(F.coalesce(F.col(ingested), F.col(fallback))) / F.lit(float(every_us)))


def merged_per_key(df: DataFrame, keys: list[str], first_batch_wins: bool,
                   order_col: str = "ingested_ts", tiebreak: str | None = "_tiebreak") -> DataFrame:
    """The table after replaying every micro-batch through a keyed MERGE, in
    closed form (M1/M2).  Inside a batch the latest delivery wins (W1); across
    batches an insert-only MERGE keeps the first committed row, an upsert the
    last.  One window on the key, so one hash exchange — the same shape as
    ``latest_per_key``."""
    slot = batch_slot(order_col)
    order = [slot.asc() if first_batch_wins else slot.desc(), F.col(order_col).desc_nulls_last()]
    if tiebreak:
        order.append(F.col(tiebreak).desc_nulls_last())
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(tiebreak) if tiebreak and tiebreak in df.columns else out
