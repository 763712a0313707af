"""Writes of many small partitions, and streams that write side by side."""

import glob
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from millstone.operators.keyed_write import overwrite_partitions
from millstone.session import side_by_side
from millstone.streaming.commits import commit, commits


def test_small_partitions_are_written_by_many_tasks(spark, scratch):
    path = f"{scratch}/t/days"
    rows = spark.range(240).select("id", (F.col("id") % 120).alias("day"))
    for large in (False, True):
        assert overwrite_partitions(rows, path, "day", large=large) == 240
        files = glob.glob(f"{path}/day=*/part-*.parquet")
        assert len(files) == 120 and sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == list(range(240))
        tasks = {os.path.basename(f).split("-")[1] for f in files}
        # joined by their bytes, 120 folders would be one task's
        assert large or len(tasks) == 8
    assert os.listdir(f"{scratch}/t/_staging") == []


def test_partitions_of_two_levels_are_replaced_and_others_stay(spark, scratch):
    path = f"{scratch}/t/slots"
    schema = "v string, day date, hour int"
    first = spark.createDataFrame([("a", None, 1), ("b", None, None), ("c", None, 2)], schema)
    assert overwrite_partitions(first, path, "day", "hour") == 3
    old = spark.read.schema(schema).parquet(path).filter("v <> 'a'")       # the table that is replaced
    assert overwrite_partitions(old.withColumn("v", F.concat("v", F.lit("/ =%"))), path, "day", "hour") == 2
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.v, r.hour or 0) for r in got) == [("a", 1), ("b/ =%", 0), ("c/ =%", 2)]
    text = spark.createDataFrame([("x", "a b/c=d%é")], "v string, k string")
    for _ in range(2):                                                     # names of folders are escaped once
        overwrite_partitions(text, f"{scratch}/t/text", "k")
        assert [r.k for r in spark.read.parquet(f"{scratch}/t/text").collect()] == ["a b/c=d%é"]


def test_streams_that_commit_at_once_all_stay_in_the_log(spark, scratch):
    streams = ["production", "vibration", "power"]
    for batch in range(3):
        side_by_side(*[partial(commit, spark, scratch, s, batch, 1, 1, 0) for s in streams])
    assert sorted((r.stream, r.batch_id) for r in commits(spark, scratch).collect()) == sorted(
        (s, b) for s in streams for b in range(3))


def test_an_error_beside_other_work_is_raised_after_it(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        side_by_side(lambda: 1 // 0, lambda: done.append(1))
    assert done == [1] and side_by_side(lambda: 1, lambda: 2) == [1, 2]
