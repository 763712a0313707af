"""Commit log and Gold refresh of touched asset-hours."""

import pytest
from pyspark.sql import functions as F

from millstone.operators.keyed_write import insert_only
from millstone.plans.catalog import Pipeline
from millstone.sources.bronze import bronze_from_events
from millstone.streaming import gold_refresh, runners
from millstone.streaming.commits import commit, commits, touched_keys, visible, write_touched
from millstone.streaming.runners import silver_batch

from .conftest import SF_SMALL

AUDIT = ("loaded_at", "hour_date", "day_part", "event_date", "shift_breakdown")


def _raw(spark, *versions):
    return bronze_from_events(spark, SF_SMALL).filter(F.col("schema_version").isin(*versions))


def _same(got, exp):
    cols = [c for c in exp.columns if c not in AUDIT]
    a, b = ([tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in d.select(*cols).collect()] for d in (got, exp))
    assert sorted(a) == sorted(b) and a


def test_a_batch_killed_between_its_sinks_is_not_visible(spark, scratch, monkeypatch):
    tables = f"{scratch}/tables"
    raw = _raw(spark, "vibration.raw.v1", "vibration.raw.v2").persist()
    half = F.pmod(F.xxhash64("asset", "event_ts"), F.lit(2)) == 0
    run = silver_batch("vibration", tables)
    run(raw.filter(half), 0)
    before = visible(spark, tables, "vibration_events").count(), visible(spark, tables, "vibration_quarantine").count()
    assert min(before) > 0

    def fails(src, path, **kw):
        if path.endswith("quarantine"):
            raise RuntimeError("lost")
        return insert_only(src, path, **kw)

    monkeypatch.setattr(runners, "insert_only", fails)
    with pytest.raises(RuntimeError, match="lost"):
        silver_batch("vibration", tables)(raw.filter(~half), 1)
    monkeypatch.undo()
    # the first sink of the batch is on disk, and neither sink shows it
    assert spark.read.parquet(f"{tables}/vibration_events").count() > before[0]
    assert (visible(spark, tables, "vibration_events").count(), visible(spark, tables, "vibration_quarantine").count()) == before
    for _ in range(2):                                    # the replay, and one after its commit
        silver_batch("vibration", tables)(raw.filter(~half), 1)
        p = Pipeline(spark, SF_SMALL)
        for name in ("vibration_events", "vibration_quarantine"):
            ids = [r[0] for r in visible(spark, tables, name).select("event_id").collect()]
            assert sorted(ids) == sorted(r[0] for r in getattr(p, name).select("event_id").collect())
    log = {r.batch_id: r for r in commits(spark, tables).collect()}
    assert set(log) == {0, 1} and sum(r.rows_in for r in log.values()) == raw.count()
    assert sum(r.rows_written for r in log.values()) == len(set(
        r[0] for r in visible(spark, tables, "vibration_events").select("event_id").collect()))
    raw.unpersist()


@pytest.mark.parametrize("domain,versions,tables_of", [
    ("production", ["0.1"], ["production_hourly"]),
    ("vibration", ["vibration.raw.v1", "vibration.raw.v2"], ["vibration_hourly"]),
    ("power", ["power_meter.raw.v1"], ["energy_hourly", "energy_daily"])])
def test_late_rows_refresh_only_their_hours(spark, scratch, domain, versions, tables_of):
    tables, ck = f"{scratch}/tables", f"{scratch}/ck"
    raw = _raw(spark, *versions).persist()
    day = F.to_date("event_ts")
    days = [r[0] for r in raw.select(day.alias("d")).where("d is not null").distinct().orderBy("d").collect()]
    late = (day == F.lit(days[len(days) // 2])) & (F.minute("event_ts") >= 30)
    run = silver_batch(domain, tables)
    run(raw.filter(~F.coalesce(late, F.lit(False))), 0)
    gold_refresh.run_gold_stream(spark, tables, ck)

    def files(name):
        return {r[0] for r in spark.read.parquet(f"{tables}/{name}").select(F.input_file_name()).distinct().collect()}

    old = {n: files(n) for n in tables_of}
    run(raw.filter(late), 1)
    seen = []
    refresh = gold_refresh.REFRESH[domain]
    gold_refresh.REFRESH[domain] = lambda s, t, touched, d: (seen.append((touched.count(), d)), refresh(s, t, touched, d))
    try:
        gold_refresh.run_gold_stream(spark, tables, ck)
        gold_refresh.run_gold_stream(spark, tables, ck)                  # nothing new: no refresh
    finally:
        gold_refresh.REFRESH[domain] = refresh
    assert len(seen) == 1 and seen[0][1] == [days[len(days) // 2]]
    p = Pipeline(spark, SF_SMALL)
    for n in tables_of:
        _same(spark.read.parquet(f"{tables}/{n}"), getattr(p, n))
        kept = old[n] & files(n)
        # other days keep their files; of the rolling means some days behind the late one change too
        assert len(kept) > 0 and (n == "vibration_hourly" or len(old[n] - kept) <= 3)
    raw.unpersist()


def test_refresh_reads_only_the_touched_days(spark, scratch):
    tables = f"{scratch}/tables"
    raw = _raw(spark, "0.1")
    silver_batch("production", tables)(raw, 0)
    touched = touched_keys(spark, tables, "production", [0])
    one = [touched.select(F.to_date("hour_utc")).first()[0]]
    plan = gold_refresh.touched_silver(spark, tables, "production_events", touched, one)._jdf.queryExecution().executedPlan().toString()
    part = [x for x in plan.split("PartitionFilters")[1:] if "event_date" in x.split("]")[0]]
    assert part and "batch_id" in part[0].split("PushedFilters")[0]


def test_log_keeps_the_last_row_of_a_replayed_batch(spark, scratch):
    t = f"{scratch}/t"
    assert commits(spark, t).count() == 0
    commit(spark, t, "power", 3, 10, 5, 0)
    commit(spark, t, "power", 3, 10, 5, 1)
    assert [(r.batch_id, r.rows_quarantined) for r in commits(spark, t).collect()] == [(3, 1)]
    b = spark.createDataFrame([(None, None), ("a", None)], "asset string, event_ts timestamp_ntz")
    assert write_touched(b, t, "power", 4) == 2 and write_touched(b.limit(0), t, "power", 5) == 0
    assert touched_keys(spark, t, "power", [4]).count() == 2
