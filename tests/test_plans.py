"""Plan-shape guarantees that matter at scale (checked on the physical plan
with AQE off, so the static plan is what is inspected)."""

import re
import tempfile

import pytest

from millstone.plans import extensions as X
from millstone.plans import gold, profiling as V
from millstone.plans.backfill import land_raw
from millstone.plans.catalog import Pipeline

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_dir(spark):
    d = tempfile.mkdtemp(prefix="millstone-raw-")
    land_raw(Pipeline(spark, SF_SMALL).bronze, d)
    return d


def _plan(spark, df) -> str:
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def _exchanges(plan: str):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)


def test_silver_production_one_shuffle_with_partial_limit(spark, raw_dir):
    p = Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)
    plan = _plan(spark, p.production_events)
    ex = _exchanges(plan)
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(asset") and "event_ts" in ex[0]
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "PartitionFilters: [isnotnull(schema_version" in plan and "(schema_version#" in plan
    assert plan.count("from_json") == 1
    # only the fixed 38-row config table is broadcast
    assert plan.count("BroadcastExchange") == 1


def test_gold_production_partial_aggregation(spark, raw_dir):
    p = Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)
    plan = _plan(spark, gold.production_hourly(p.production_events, p.machine_config))
    assert "partial_count" in plan
    assert len(_exchanges(plan)) == 2        # dedup + hourly aggregation


def test_vibration_hourly_single_scan(spark, raw_dir):
    p = Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)
    plan = _plan(spark, gold.vibration_hourly(p.vibration_events))
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("build", [V.counter_resets, X.setup_runs])
def test_sequence_ops_read_and_shuffle_rows_once(spark, raw_dir, build):
    p = Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)
    plan = _plan(spark, build(p))
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "ReusedExchange" in plan
    # no window ever partitions raw readings by asset alone
    assert not re.search(r"Exchange hashpartitioning\(asset#\d+, \d+\), ENSURE_REQUIREMENTS.*\n.*Window", plan)


def test_domain_reads_are_partition_pruned(spark, raw_dir):
    plan = _plan(spark, V.bronze_by_domain(Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)))
    pruned = re.findall(r"PartitionFilters: \[[^\]]*schema_version[^\]]*\]", plan)
    assert len(pruned) == 3, plan


def test_dedup_aggregates_before_its_one_shuffle(spark, raw_dir):
    from millstone.plans import incremental as M
    plan = _plan(spark, M.dedup_production(Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)))
    ex = _exchanges(plan)
    assert len(ex) == 1 and "asset" in ex[0] and "event_ts" in ex[0], ex
    assert "partial_max_by" in plan or "partial_count" in plan, plan


def test_merge_replay_is_one_window_shuffle(spark, raw_dir):
    from millstone.plans import incremental as M
    plan = _plan(spark, M.merge_insert_only(Pipeline(spark, SF_SMALL, bronze_dir=raw_dir)))
    ex = [e for e in _exchanges(plan) if "asset" in e and "event_ts" in e]
    assert len(ex) == 1 and "WindowGroupLimit" in plan, plan


def test_last_seven_days_opens_a_few_days_of_silver(spark, scratch):
    from millstone.plans import backfill
    from millstone.plans import business as B
    p = Pipeline(spark, SF_SMALL)
    tables = f"{scratch}/tables"
    backfill.write_silver(p, tables)
    backfill.write_gold(spark, Pipeline(spark, SF_SMALL, tables_dir=tables), tables)
    written = B.q2_zone_last_7d(Pipeline(spark, SF_SMALL, tables_dir=tables))
    assert sorted(written.collect()) == sorted(B.q2_zone_last_7d(p).collect())
    plan = _plan(spark, written)
    scans = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
    assert sum("event_date" in x for x in scans) >= 1 and not any(x == "" and "vibration_events" in x for x in scans)


def test_a_payload_filter_does_not_build_the_text_again(spark):
    p = Pipeline(spark, SF_SMALL)
    for df in (p.production_events, p.power_events, p.vibration_events):
        plan = _plan(spark, df)
        filters = "\n".join(x for x in plan.splitlines() if re.match(r"[^A-Za-z]*(\*\(\d+\) )?Filter", x))
        assert "json_object_keys" in filters and "to_json" not in filters and "get_json_object" not in filters


def test_silver_of_an_incremental_plan_is_derived_once(spark):
    from millstone.plans import incremental as M
    p = Pipeline(spark, SF_SMALL)
    for df in (M.gold_refresh_incremental(p), M.watermark_filter(p)):
        plan = _plan(spark, df)
        assert "from_json" not in plan and "events.parquet" not in plan
