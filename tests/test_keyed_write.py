"""Keyed writes: first-wins insert, last-wins upsert, replays are no-ops."""

from datetime import date, datetime

from millstone.operators.keyed_write import insert_only, upsert

SCHEMA = "event_id string, v long, event_date date"


def _read(spark, path):
    return sorted((r.event_id, r.v) for r in spark.read.parquet(path).collect())


def test_insert_only_first_wins_and_replay(spark, scratch):
    path = f"{scratch}/t"
    b1 = spark.createDataFrame([("a", 1, date(2024, 1, 1)), ("b", 2, date(2024, 1, 2))], SCHEMA)
    b2 = spark.createDataFrame([("a", 9, date(2024, 1, 1)), ("c", 3, date(2024, 1, 1))], SCHEMA)
    assert insert_only(b1, path, "event_id", "event_date") == 2
    assert insert_only(b2, path, "event_id", "event_date") == 1
    assert insert_only(b2, path, "event_id", "event_date") == 0      # replay
    assert _read(spark, path) == [("a", 1), ("b", 2), ("c", 3)]


def test_upsert_last_wins_and_replay(spark, scratch):
    path = f"{scratch}/u"
    b1 = spark.createDataFrame([("a", 1, date(2024, 1, 1)), ("b", 2, date(2024, 1, 2))], SCHEMA)
    b2 = spark.createDataFrame([("a", 9, date(2024, 1, 1)), ("c", 3, date(2024, 1, 1))], SCHEMA)
    upsert(b1, path, ["event_id"], "event_date", "b1")
    upsert(b2, path, ["event_id"], "event_date", "b2")
    upsert(b2, path, ["event_id"], "event_date", "b2")            # replay of the same batch
    assert _read(spark, path) == [("a", 9), ("b", 2), ("c", 3)]


def test_upsert_null_safe_composite_key(spark, scratch):
    path = f"{scratch}/n"
    s = "asset string, floor int, v long, event_date date"
    d = date(2024, 1, 1)
    upsert(spark.createDataFrame([("m", None, 1, d), ("m", 1, 2, d)], s), path, ["asset", "floor"], "event_date", "x")
    upsert(spark.createDataFrame([("m", None, 5, d)], s), path, ["asset", "floor"], "event_date", "y")
    got = sorted((r.floor if r.floor is not None else -1, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(-1, 5), (1, 2)]


def test_insert_only_time_window_any_session_zone(spark, scratch):
    """Replay under a non-UTC session must still find the stored rows."""
    path = f"{scratch}/z"
    s = "event_id string, event_ts timestamp_ntz, event_date date"
    t = datetime(2024, 3, 10, 2, 30)      # inside a US DST gap
    b = spark.createDataFrame([("a", t, date(2024, 3, 10))], s)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert insert_only(b, path, "event_id", "event_date") == 1
        assert insert_only(b, path, "event_id", "event_date") == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merge_closed_form_equals_replayed_batches(spark, tmp_path):
    """``merged_per_key`` (one window) gives the table that replaying the
    15-minute batches through insert_only / upsert writes."""
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from millstone.operators.dedup import batch_slot, latest_per_key, merged_per_key

    base = datetime(2024, 1, 1)
    rows = []
    for k in range(12):
        ets = base + timedelta(minutes=k)
        lags = [1, 66 + 60 * (k % 3), 903 + 900 * (k % 4)] + ([2705] if k % 5 == 0 else [])
        rows += [(f"k{k}", ets, ets + timedelta(seconds=s), 10 * k + j) for j, s in enumerate(lags)]
        if k % 7 == 0:
            rows.append((f"k{k}", ets, None, 10 * k + 9))    # no ingest time: lands with its event time
    df = spark.createDataFrame(rows, "event_id string, event_ts timestamp_ntz, ingested_ts timestamp_ntz, v long") \
        .withColumn("event_date", F.to_date("event_ts"))
    ins, ups = str(tmp_path / "ins"), str(tmp_path / "ups")
    slots = sorted(r[0] for r in df.select(batch_slot().alias("s")).distinct().collect())
    assert len(slots) > 3
    for s in slots:
        b = latest_per_key(df.filter(batch_slot() == s), ["event_id"], tiebreak=None)
        insert_only(b, ins, "event_id", "event_date")
        upsert(b, ups, ["event_id"], "event_date", f"slot-{s}")

    def pairs(d):
        return sorted((r.event_id, r.v) for r in d.select("event_id", "v").collect())
    assert pairs(spark.read.parquet(ins)) == pairs(merged_per_key(df, ["event_id"], True, tiebreak=None))
    assert pairs(spark.read.parquet(ups)) == pairs(merged_per_key(df, ["event_id"], False, tiebreak=None))
    # the two rules really differ on this input
    assert pairs(spark.read.parquet(ins)) != pairs(spark.read.parquet(ups))


def test_null_key_and_null_date(spark, scratch):
    """NULL partitions are merged like days, NULL keys are found on replay."""
    rows = [("a", 1, None), (None, 2, None), ("c", 3, date(2024, 1, 1))]
    b1 = spark.createDataFrame(rows, SCHEMA)
    b2 = spark.createDataFrame([("b", 4, None), ("c", 5, date(2024, 1, 1))], SCHEMA)
    path = f"{scratch}/null-insert"
    assert insert_only(b1, path, "event_id", "event_date") == 3
    assert insert_only(b1, path, "event_id", "event_date") == 0
    path = f"{scratch}/null-upsert"
    assert upsert(b1, path, ["event_id"], "event_date", "n1") == 3
    assert upsert(b2, path, ["event_id"], "event_date", "n2") == 2
    got = {(r.event_id, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1), (None, 2), ("b", 4), ("c", 5)}
    only = spark.createDataFrame([("d", 6, None)], SCHEMA)
    assert upsert(only, f"{scratch}/null-only", ["event_id"], "event_date", "n3") == 1


def _files(spark, path, where):
    rows = spark.read.parquet(path).where(where).select("_metadata.file_path").distinct().collect()
    return sorted(r[0] for r in rows)


def test_upsert_rewrites_touched_hours_only(spark, scratch):
    """A late row of one hour leaves the files of the day's other hours alone,
    and only that hour's files are opened."""
    import pytest

    from millstone.operators.keyed_write import in_slots
    s = "event_id string, v long, event_date date, event_hour int"
    d, parts, path = date(2024, 1, 1), ["event_date", "event_hour"], f"{scratch}/hourly"
    first = [("a", 1, d, 0), ("b", 2, d, 1), ("c", 3, date(2024, 1, 2), 1), ("n", 4, d, None), (None, 5, None, None)]
    upsert(spark.createDataFrame(first, s), path, ["event_id"], parts, "h1")
    rest = "not (event_date <=> date'2024-01-01' and event_hour <=> 1)"
    before, hour = _files(spark, path, rest), _files(spark, path, f"not ({rest})")
    late = spark.createDataFrame([("b", 9, d, 1), ("e", 6, d, 1)], s)
    for _ in range(2):      # and its replay
        assert upsert(late, path, ["event_id"], parts, "h2") == 2
    assert _files(spark, path, rest) == before and _files(spark, path, f"not ({rest})") != hour
    got = {(r.event_id, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1), ("b", 9), ("c", 3), ("n", 4), (None, 5), ("e", 6)}
    upsert(spark.createDataFrame([("n", 7, d, None)], s), path, ["event_id"], parts, "h3")
    assert {(r.event_id, r.v) for r in spark.read.parquet(path).where("event_id = 'n'").collect()} == {("n", 7)}
    read = spark.read.schema(s).parquet(path).filter(in_slots(parts, [(d, 1)]))
    assert len(read.select("_metadata.file_path").distinct().collect()) == 1
    assert "PartitionFilters: [isnotnull" in read._jdf.queryExecution().toString() or "PartitionFilters: [(" in \
        read._jdf.queryExecution().toString()
    with pytest.raises(ValueError):     # a table of another layout is not touched
        upsert(late.drop("event_hour"), path, ["event_id"], "event_date", "h4")
