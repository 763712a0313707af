"""Session helpers.

The library never depends on the session time zone: all time columns are
``TIMESTAMP_NTZ`` (UTC wall clock) and truncation is done with NTZ-only
functions.  ``spark.checkpoint.dir`` is read from the session; a scratch
default is set only when the cluster did not name one (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: whether shuffle files go when the query that wrote them ends
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = {"users": 0, "before": None}
_CLEANING = threading.Lock()


def build_session(master: str | None = None, app: str = "millstone",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests / bench.  On a cluster pass ``master=None`` and let
    spark-submit decide; shuffle partitions then follow AQE coalescing."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a dimension must be proven small to be broadcast; reference
        # tables are broadcast explicitly, nothing else is auto-broadcast
        # beyond this bound
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when a local session has none (tests) a fresh scratch folder is
    created and registered; on a cluster that is an error.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="millstone-ckpt-", dir=os.environ.get("MILLSTONE_SCRATCH", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for staged writes."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each query are removed at its end (streams
    that start inside take the setting along).  Otherwise they lie on the disk until the driver's
    garbage collector happens to meet the query's plan, and a run of many writes
    holds all of their rows at once.  Threads may enter at the same time."""
    with _CLEANING:
        if not _cleaning["users"]:
            _cleaning["before"] = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
            spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
        _cleaning["users"] += 1
    try:
        yield
    finally:
        with _CLEANING:
            _cleaning["users"] -= 1
            if not _cleaning["users"]:
                if _cleaning["before"] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP_CONF)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP_CONF, _cleaning["before"])


def side_by_side(*calls: Callable) -> list:
    """Results of calls whose jobs do not depend on each other.  All of them
    end before the first error is raised."""
    with ThreadPoolExecutor(len(calls)) as pool:
        done = [pool.submit(c) for c in calls]
    return [d.result() for d in done]
