"""Keyed writes on plain Parquet tables partitioned by a date column (M1/M2).

No table format with MERGE is assumed.  Precondition: the partition value
is a function of the key (event ids embed the event time, so the event date
follows from the key).  Both writes touch only the date partitions present
in the incoming batch (a bounded list: the days a batch
covers), so the target read is partition-pruned.

* ``insert_only`` — first committed row wins: anti-join against the keys
  already in the touched partitions, then append.  Re-running the same
  batch (after a crash before the stream checkpoint advanced) finds its rows
  and appends nothing, so the write is idempotent.
  A NULL key matches a NULL key, a NULL partition value is a partition.
  With ``commit=(stream, batch_id)`` the rows go below those partitions: a
  replay overwrites what its batch left and looks for known keys in earlier
  batches only.
* ``upsert`` — the batch wins: touched partitions that hold one of its keys are
  merged and published, to the others its files are added.  Replays find all
  of their keys, merge and publish again.
  Below the day there may be a finer partition (the hour): then only the
  touched hours are read, and of these the merged ones rewritten; other files stay.
* Both write the batch to its staging folder first and compare keys afterwards,
  from those files: only keys cross a shuffle, and only where a key is known are
  rows written again.  A batch that is ``placed`` (its tasks hold whole
  partitions, or large shares of them) is written as it is.
* ``overwrite_partitions`` — replaces some partitions.  They are written to a
  staging folder beside the table by the tasks alone (a path is never
  overwritten while it is being read), then each folder is moved into its
  place, many at a time: the driver's share of a write is one move a partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: partitions that name the commit of a row
COMMIT = ["stream", "batch_id"]
#: folders moved at once
MOVERS = 16
#: rows of a partition that one task writes
LARGE = 1_000_000
#: sorted by these, rows of a file pack better and are skipped by their statistics
FILE_ORDER = ["asset", "event_ts"]


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # output only appears at job commit (dynamic overwrite leaves no
    # _SUCCESS marker at the root), so the folder itself is the signal
    return bool(fs.exists(p))


def touched_values(src: DataFrame, partition_col: str) -> list:
    """Distinct partition values in a batch (days: a short list)."""
    return [r[0] for r in src.select(partition_col).distinct().collect()]


def touched_slots(src: DataFrame, partition_cols: list[str]) -> list[tuple]:
    """Distinct partitions of several levels (hours: 24 a day at most)."""
    return [tuple(r) for r in src.select(*partition_cols).distinct().collect()]


def _rows_of(src: DataFrame, partition_cols: list[str]) -> dict[tuple, int]:
    """Rows of each partition in a batch."""
    return {tuple(r)[:-1]: r[-1] for r in src.groupBy(*partition_cols).agg(F.count(F.lit(1))).collect()}


def utc_now():
    """UTC wall clock as NTZ, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", utc_now())


def _in_partitions(partition_col: str, values: list):
    """Rows of these partitions; a NULL value is a partition of its own."""
    known = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(known) if known else F.lit(False)
    return cond | F.col(partition_col).isNull() if len(known) < len(values) else cond


def in_slots(partition_cols: list[str], slots: list[tuple]):
    """Rows of these partitions of one or more levels; NULL is a value."""
    first, rest = partition_cols[0], partition_cols[1:]
    if not rest:
        return _in_partitions(first, [v[0] for v in slots])
    below: dict = {}
    for v in slots:
        below.setdefault(v[0], []).append(v[1:])
    each = [_in_partitions(first, [v]) & in_slots(rest, subs) for v, subs in below.items()]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def insert_only(src: DataFrame, path: str, key: str, partition_col: str,
                range_col: str | None = "event_ts", commit: tuple[str, int] | None = None,
                placed: bool = False) -> int:
    """Returns the rows written.  ``range_col``: a column the key embeds (event
    ids embed the event time); existing rows outside the batch's [min, max]
    cannot collide, so the target read is narrowed by a pushed-down range filter
    (row-group skipping on time-sorted files) instead of reading whole days of
    keys."""
    if commit:
        return _insert_committed(src, path, key, partition_col, range_col, commit, placed)
    spark = src.sparkSession
    src = src.persist()
    try:
        days = touched_values(src, partition_col)
        if not days:
            return 0
        new = src
        if table_exists(spark, path):
            existing = spark.read.schema(_stamp(src).schema).parquet(path).filter(_in_partitions(partition_col, days))
            known = _in_range_of(src, existing, range_col).select(key)
            new = src.join(known, src[key].eqNullSafe(known[key]), "left_anti")
        new = _stamp(new).persist()
        n = new.count()
        if n:
            new.write.mode("append").partitionBy(partition_col).parquet(path)
        new.unpersist()
        return n
    finally:
        src.unpersist()


def _in_range_of(src: DataFrame, existing: DataFrame, range_col: str | None) -> DataFrame:
    """Existing rows that may hold a key of ``src``."""
    if not range_col or range_col not in src.columns:
        return existing
    # bounds travel as text and are cast back to the column's type
    # (a Python datetime literal would be a session-zone TIMESTAMP)
    typ = src.schema[range_col].dataType
    lo, hi = src.agg(F.min(range_col).cast("string"), F.max(range_col).cast("string")).first()
    if lo is None:
        return existing
    return existing.filter(F.col(range_col).between(F.lit(lo).cast(typ), F.lit(hi).cast(typ)) | F.col(range_col).isNull())


def _insert_committed(src: DataFrame, path: str, key: str, partition_col: str, range_col: str | None,
                      commit: tuple[str, int], placed: bool) -> int:
    spark = src.sparkSession
    parts = [partition_col, *COMMIT]
    src = _with_commit(_stamp(src), commit)
    with _staged(src, path, parts, placed) as (stage, rows):
        if rows and table_exists(spark, path):
            fresh = spark.read.schema(src.schema).parquet(stage)
            earlier = (spark.read.schema(src.schema).parquet(path)
                       .filter(_in_partitions(partition_col, touched_values(fresh, partition_col)))
                       .filter((F.col("stream") == commit[0]) & (F.col("batch_id") < commit[1])))
            known = _in_range_of(fresh, earlier, range_col).select(key)
            keys = fresh.select(key)
            if not keys.join(known, _null_safe_on(keys, known, [key]), "left_semi").isEmpty():
                return overwrite_partitions(fresh.join(known, _null_safe_on(fresh, known, [key]), "left_anti"), path, *parts,
                                            large=max(_rows_of(fresh, parts).values()) > LARGE)
        if rows:
            _move_partitions(spark, stage, path, len(parts))
        return rows


def _with_commit(df: DataFrame, commit: tuple[str, int] | None) -> DataFrame:
    if not commit:
        return df
    return df.withColumn("stream", F.lit(commit[0])).withColumn("batch_id", F.lit(commit[1]).cast("long"))


def upsert(src: DataFrame, path: str, keys: list[str], partition_cols: str | list[str], batch_tag: str,
           placed: bool = False) -> int:
    """Returns the rows of the batch, all of which are in the table after it.
    The table has to have these partition columns from its first write on."""
    spark = src.sparkSession
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    src = _stamp(src)
    with _staged(src, path, parts, placed) as (stage, rows):
        if not rows:
            return 0
        published: set[str] = set()
        if table_exists(spark, path):
            if (stored := _partition_columns(spark, path)) != parts:
                raise ValueError(f"{path} is partitioned by {stored}, not by {parts}")
            fresh = spark.read.schema(src.schema).parquet(stage)
            old = spark.read.schema(src.schema).parquet(path).filter(in_slots(parts, touched_slots(fresh, parts)))
            of = fresh.select(*keys)
            old_keys = old.select(*dict.fromkeys([*keys, *parts]))
            merged = touched_slots(old_keys.join(of, _null_safe_on(old_keys, of, keys), "left_semi"), parts)
            if merged:
                of_merged = fresh.filter(in_slots(parts, merged))
                old = old.filter(in_slots(parts, merged))
                keep = old.join(of, _null_safe_on(old, of, keys), "left_anti")
                rows_of = _rows_of(of_merged.select(*parts).unionByName(old.select(*parts)), parts)
                _, published = _replace(of_merged.unionByName(keep.select(*src.columns)), path, parts,
                                        max(rows_of.values()) > LARGE)
        _move_partitions(spark, stage, path, len(parts), added=True, but=published)
        return rows


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a stored table, by the folders of one of its files."""
    some = spark.read.parquet(path).select("_metadata.file_path").first()
    root = path.rstrip("/").rsplit("/", 1)[-1]
    return [f.split("=", 1)[0] for f in some[0].rsplit(f"/{root}/", 1)[-1].split("/")[:-1]] if some else []


def overwrite_partitions(df: DataFrame, path: str, *partition_cols: str, large: bool = False) -> int:
    """Replace exactly the partitions present in ``df``: one file each, whatever
    the number of tasks that made ``df``, dealt to as many tasks as a shuffle
    has.  Where a partition may be ``large``, it is split, and tasks take several
    small ones.  Returns the rows, counted in the footers of the files."""
    return _replace(df, path, list(partition_cols), large)[0]


def _replace(df: DataFrame, path: str, parts: list[str], large: bool) -> tuple[int, set[str]]:
    """``overwrite_partitions``; the folders, too."""
    with _staged(_dealt(df, parts, large), path, parts, True) as (stage, rows):
        return rows, _move_partitions(df.sparkSession, stage, path, len(parts))


def _dealt(df: DataFrame, parts: list[str], large: bool) -> DataFrame:
    # a file costs a task the same time however few its rows: few rows in many
    # partitions would all be one task's if tasks were sized by their bytes
    return (df.hint("rebalance", *parts) if large
            else df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *parts))


@contextmanager
def _staged(df: DataFrame, path: str, parts: list[str], placed: bool) -> Iterator[tuple[str, int]]:
    """The rows of ``df`` in a folder beside the table, and their number.  The
    tasks of a ``placed`` frame write the partitions that they hold; others are dealt
    by partitions first, after a count of their rows."""
    spark = df.sparkSession
    table, name = path.rstrip("/").rsplit("/", 1)
    stage = f"{table}/_staging/{name}-{uuid.uuid4().hex}"
    held = None
    try:
        if not placed:
            held = df.persist()
            df = _dealt(df, parts, max(_rows_of(df, parts).values(), default=0) > LARGE)
        # nobody reads the stage before the job's end: tasks may put their files there themselves
        (df.sortWithinPartitions(*parts, *[c for c in FILE_ORDER if c in df.columns and c not in parts])
           .write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("compression", "zstd")
           .partitionBy(*parts).parquet(stage))
        if held:
            held.unpersist()
        yield stage, spark.read.schema(df.schema).parquet(stage).count()
    finally:
        if held:
            held.unpersist()
        _remove(spark, stage)


def _move_partitions(spark: SparkSession, stage: str, path: str, levels: int, added: bool = False,
                     but: Collection[str] = ()) -> set[str]:
    """Moves the partition folders of ``stage`` into the places of those of
    ``path``, or ``added`` to their files.  Returns the folders."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at(path))

    def below(folder: str) -> list[str]:
        names = [s.getPath().getName() for s in fs.listStatus(at(f"{stage}{folder}")) if s.isDirectory()]
        return [f"{folder}/{n}" for n in names if "=" in n]

    def rename(name: str) -> None:
        if not fs.rename(at(f"{stage}{name}"), at(f"{path}{name}")):
            raise RuntimeError(f"{path}{name} could not be replaced")

    def move(folder: str) -> None:
        old = at(f"{path}{folder}")
        if added and fs.exists(old):
            for s in fs.listStatus(at(f"{stage}{folder}")):
                rename(f"{folder}/{s.getPath().getName()}")
            return
        fs.delete(old, True)
        fs.mkdirs(old.getParent())
        rename(folder)

    with ThreadPoolExecutor(MOVERS) as pool:
        folders = [""]
        for _ in range(levels):
            folders = [f for some in pool.map(below, folders) for f in some]
        folders = [f for f in folders if f not in but]
        list(pool.map(move, folders))
    return set(folders)
