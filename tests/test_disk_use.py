"""What a streamed run keeps on the disk: a message lies there once, shuffle
files go with their query, and a batch is shuffled and written once."""

import glob
import os
import re
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millstone.operators.dedup import latest_in_slots, latest_per_key
from millstone.operators.keyed_write import insert_only, upsert
from millstone.plans import registry
from millstone.plans.catalog import Pipeline
from millstone.session import SHUFFLE_CLEANUP_CONF, shuffles_removed
from millstone.sources import bronze
from millstone.streaming import queries
from millstone.streaming.runners import DROP, deliver

S = "asset string, event_ts timestamp_ntz, ingested_ts timestamp_ntz, v long"
AT = datetime(2024, 1, 1)


def _size(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


@pytest.mark.parametrize("keep", [True, False])
def test_a_delivered_message_lies_on_disk_once(spark, scratch, keep):
    rows = [(f"m{k}", "x" * 500 + str(k), k % 3) for k in range(300)]
    dropped = spark.createDataFrame(rows, f"asset string, payload string, {DROP} int").repartition(4)
    seen, sizes = [], []

    def run(landing):
        # what came before was moved here, or is gone
        seen.append(sorted(r.asset for r in spark.read.parquet(landing).collect()))
        sizes.append(_size(scratch))

    deliver(dropped, scratch, run, keep)
    drops = [sorted(a for a, _, d in rows if d == k) for k in range(3)]
    assert seen == ([drops[0], sorted(drops[0] + drops[1]), sorted(sum(drops, []))] if keep else drops)
    assert glob.glob(f"{scratch}/outbox/**/*.parquet", recursive=True) == []
    assert len(set(sizes)) == 1 if keep else sizes == sorted(sizes, reverse=True) and sizes[0] > 2 * sizes[2] > 0
    assert (_size(f"{scratch}/landing") > 0) == keep


def test_shuffle_files_go_with_their_query(spark, scratch):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    def write(df, name):
        before = shuffled()
        df.write.parquet(f"{scratch}/{name}")
        for _ in range(100):
            if not shuffled() - before:
                break
            time.sleep(0.1)
        return len(shuffled() - before)

    rows = spark.range(20000).repartition(8, "id")
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            assert write(rows, "a") == 0
        kept = spark.range(100).repartition(8, "id").persist()       # held rows outlive the query that made them
        assert kept.count() == 100 and write(kept.filter("id < 50"), "b") == 0 and kept.agg(F.sum("id")).first()[0] == 4950
        kept.unpersist()
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == before
    assert spark.read.parquet(f"{scratch}/a").count() == 20000 and spark.read.parquet(f"{scratch}/b").count() == 50


def _messages(spark):
    rows = [(f"m{k % 3}" if k % 11 else None, AT + timedelta(hours=k % 50) if k % 13 else None,
             AT + timedelta(seconds=k) if k % 7 else None, k) for k in range(600)]
    return spark.createDataFrame(rows, S).withColumn("_tiebreak", F.xxhash64("v"))


@pytest.mark.parametrize("buckets", [1, 4])
def test_dedup_by_slots_keeps_the_same_rows_in_one_exchange(spark, scratch, buckets):
    df, keys = _messages(spark), ["asset", "event_ts"]
    slots = [F.to_date("event_ts"), F.hour("event_ts")]
    got = latest_in_slots(slots, 8, buckets)(df, keys)
    assert got.columns == ["asset", "event_ts", "ingested_ts", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, latest_per_key(df, keys).collect()))
    plan = got.sortWithinPartitions("asset")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange (?!SinglePartition)", plan)) == 1


def test_upsert_rewrites_only_partitions_with_a_known_key(spark, scratch):
    s, path, d = "event_id string, v long, event_date date", f"{scratch}/t", [date(2024, 1, k) for k in (1, 2, 3)]

    def files(day):
        return set(glob.glob(f"{path}/event_date={day}/*.parquet"))

    upsert(spark.createDataFrame([("a", 1, d[0]), ("b", 2, d[1]), (None, 3, None)], s), path, ["event_id"], "event_date", "1")
    before = [files(x) for x in d[:2]]
    late = spark.createDataFrame([("a2", 4, d[0]), ("b", 5, d[1]), ("b2", 6, d[1]), ("c", 7, d[2]), (None, 8, None)], s)
    want = {("a", 1), ("a2", 4), ("b", 5), ("b2", 6), ("c", 7), (None, 8)}
    assert upsert(late, path, ["event_id"], "event_date", "2") == 5
    # rows of a day without a known key stay where they are, the others' day is written again
    assert before[0] < files(d[0]) and not before[1] & files(d[1]) and len(files(d[1])) == 1
    assert {(r.event_id, r.v) for r in spark.read.parquet(path).collect()} == want
    assert upsert(late, path, ["event_id"], "event_date", "2") == 5                # its replay
    got = [(r.event_id, r.v) for r in spark.read.parquet(path).collect()]
    assert len(got) == 6 and set(got) == want and os.listdir(f"{scratch}/_staging") == []


@pytest.mark.parametrize("placed", [False, True])
def test_committed_insert_writes_known_keys_never_twice(spark, scratch, placed):
    s, path = "event_id string, event_ts timestamp_ntz, v long, event_date date", f"{scratch}/t"

    def batch(k, rows):
        rows = [(i, AT + timedelta(days=t) if t is not None else None, v, (AT + timedelta(days=t)).date() if t is not None else None)
                for i, t, v in rows]
        return insert_only(spark.createDataFrame(rows, s), path, "event_id", "event_date", commit=("x", k), placed=placed)

    assert batch(0, [("a", 0, 1), ("b", 1, 2), (None, None, 3)]) == 3
    assert batch(1, [("c", 0, 4), ("d", 2, 5)]) == 2                               # no known key
    for _ in range(2):                                                             # and its replay
        assert batch(2, [("a", 0, 6), ("e", 1, 7), (None, None, 8)]) == 1
    got = sorted((str(r.event_id), r.v, r.batch_id) for r in spark.read.parquet(path).collect())
    assert got == [("None", 3, 0), ("a", 1, 0), ("b", 2, 0), ("c", 4, 1), ("d", 5, 1), ("e", 7, 2)]
    assert batch(3, []) == 0 and os.listdir(f"{scratch}/_staging") == []


def test_tasks_of_the_fan_out_follow_the_stored_bytes(spark, scratch, monkeypatch):
    rows = [(k, AT + timedelta(minutes=k), k, ["view", "error", "purchase"][k % 3], 1.0, '{"k": 5}') for k in range(300)]
    path = f"{scratch}/events.parquet"
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(path)
    few = bronze.bronze_from_events(spark, scratch)
    monkeypatch.setattr(bronze, "TASK_BYTES", _size(path) // 40)
    many = bronze.bronze_from_events(spark, scratch)
    assert many.rdd.getNumPartitions() >= 3 * 40 and few.rdd.getNumPartitions() <= 3 * 8
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty() and few.count() > 1800


def test_alerts_of_two_deliveries_hold_each_message_once(spark, scratch, monkeypatch):
    rows = [(k, AT + timedelta(minutes=7 * k), k % 9, ["view", "error", "purchase"][k % 3], 60.0 + k % 40, f'{{"k": {k % 100}}}')
            for k in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{scratch}/events.parquet")
    raw = bronze.bronze_from_events(spark, scratch).count()
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{scratch}/root")
    gold, seen = queries.run_gold_stream, []

    def messages(folder):
        return sum(spark.read.parquet(f).count() for f in glob.glob(f"{scratch}/root/{folder}/**/*.parquet", recursive=True))

    def run(spark, tables, checkpoints):
        seen.append((messages("outbox"), messages("landing")))
        gold(spark, tables, checkpoints)

    monkeypatch.setattr(queries, "run_gold_stream", run)
    got = queries.stream_alerts(spark, scratch)
    want = registry.PLANS["alerts"](Pipeline(spark, scratch))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 0
    (later, first), (none, second) = seen
    assert first > 0 and second == later > 0 == none and first + second == raw
    assert messages("outbox") == messages("landing") == 0
