"""Operators against brute force on small random fixtures."""

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from millstone.operators.dedup import latest_per_key
from millstone.operators.islands import state_runs
from millstone.operators.sequence import running_max, with_previous


def _series(n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    rows, seen = [], set()
    while len(rows) < n:
        k = f"k{rnd.randrange(keys)}"
        t = base + timedelta(seconds=rnd.randrange(0, 3 * 86400))
        if (k, t) in seen:
            continue
        seen.add((k, t))
        rows.append((k, t, rnd.randrange(0, 50), rnd.random() < 0.4))
    return rows


def test_latest_per_key_nulls_last(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, None, "x"), ("a", t, t, "y"), ("b", t, None, "z")],
                               "asset string, event_ts timestamp_ntz, ingested_ts timestamp_ntz, p string")
    got = {r.asset: r.p for r in latest_per_key(df, ["asset", "event_ts"], tiebreak=None).collect()}
    assert got == {"a": "y", "b": "z"}


def test_with_previous_equals_lag(spark):
    rows = _series()
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v long, s boolean")
    got = {(r.k, r.ts): (r.prev_ts, r.prev_v) for r in with_previous(df, "k", "ts", ["v"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "ts", "v", "s"]).sort_values(["k", "ts"])
    pdf["pt"] = pdf.groupby("k")["ts"].shift(1)
    pdf["pv"] = pdf.groupby("k")["v"].shift(1)
    for r in pdf.itertuples():
        pt, pv = got[(r.k, r.ts.to_pydatetime())]
        assert (pt is None and pd.isna(r.pt)) or pt == r.pt.to_pydatetime()
        assert (pv is None and pd.isna(r.pv)) or pv == r.pv


def test_running_max_equals_cummax(spark):
    rows = _series(seed=3)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v long, s boolean") \
        .withColumn("m", F.when(F.col("s"), F.col("v")))
    got = {(r.k, r.ts): r.rm for r in running_max(df, "k", "ts", "m", "rm").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "ts", "v", "s"]).sort_values(["k", "ts"])
    pdf["m"] = pdf["v"].where(pdf["s"])
    pdf["rm"] = pdf.groupby("k")["m"].cummax()
    pdf["rm"] = pdf.groupby("k")["rm"].ffill()   # cummax leaves NaN in place
    for r in pdf.itertuples():
        g = got[(r.k, r.ts.to_pydatetime())]
        assert (g is None and pd.isna(r.rm)) or g == r.rm


def test_state_runs_equals_brute_force(spark):
    rows = _series(seed=11)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v long, s boolean")
    got = sorted((r.k, r.run_start, r.run_end, r.readings) for r in state_runs(df, "k", "ts", F.col("s")).collect())
    exp = []
    for k in sorted({r[0] for r in rows}):
        seq = sorted((r[1], r[3]) for r in rows if r[0] == k)
        cur = None
        for t, s in seq:
            if s and cur is None:
                cur = [t, t, 1]
            elif s:
                cur[1], cur[2] = t, cur[2] + 1
            elif cur is not None:
                exp.append((k, cur[0], cur[1], cur[2]))
                cur = None
        if cur is not None:
            exp.append((k, cur[0], cur[1], cur[2]))
    assert got == sorted(exp)
