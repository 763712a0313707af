"""Lazily composed pipeline over one input folder.

``Pipeline(spark, sf_dir)`` exposes Bronze, Silver and Gold frames as
properties.  Nothing is materialised: each property is a logical plan, so a
query that needs only Gold production reads only the production columns of
the raw table (column pruning + pushed filters reach the Parquet scan).
Pass ``tables_dir`` to read already-written Silver/Gold tables instead.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from millstone.plans import gold, silver
from millstone.sources import refdata
from millstone.streaming.commits import visible
from millstone.sources.bronze import bronze_from_events, load_bronze


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, tables_dir: str | None = None,
                 strict_reference: bool = False, bronze_dir: str | list[str] | None = None):
        self.spark, self.sf_dir, self.tables_dir = spark, sf_dir.rstrip("/"), tables_dir
        self.strict_reference = strict_reference
        self.bronze_dir = bronze_dir

    def _table(self, name: str, build):
        if self.tables_dir:
            return visible(self.spark, self.tables_dir, name)
        return build()

    # reference data -------------------------------------------------------
    @cached_property
    def machine_config(self) -> DataFrame:
        return refdata.machine_config(self.spark)

    @cached_property
    def reason_codes(self) -> DataFrame:
        return refdata.reason_codes(self.spark)

    # bronze ----------------------------------------------------------------
    @cached_property
    def bronze(self) -> DataFrame:
        if self.bronze_dir:
            dirs = [self.bronze_dir] if isinstance(self.bronze_dir, str) else list(self.bronze_dir)
            return load_bronze(self.spark, *dirs)
        return bronze_from_events(self.spark, self.sf_dir)

    # silver ----------------------------------------------------------------
    @cached_property
    def production_events(self) -> DataFrame:
        return self._table("production_events", lambda: silver.silver_production(
            self.bronze, self.machine_config, self.strict_reference))

    @cached_property
    def vibration_routed(self) -> DataFrame:
        return silver.route_vibration(self.bronze)

    @cached_property
    def vibration_events(self) -> DataFrame:
        return self._table("vibration_events", lambda: silver.silver_vibration(self.vibration_routed))

    @cached_property
    def vibration_quarantine(self) -> DataFrame:
        return self._table("vibration_quarantine", lambda: silver.silver_quarantine(self.vibration_routed))

    @cached_property
    def power_events(self) -> DataFrame:
        return self._table("power_events", lambda: silver.silver_power(self.bronze))

    # gold ------------------------------------------------------------------
    @cached_property
    def production_hourly(self) -> DataFrame:
        return self._table("production_hourly", lambda: gold.production_hourly(
            self.production_events, self.machine_config))

    @cached_property
    def vibration_hourly(self) -> DataFrame:
        return self._table("vibration_hourly", lambda: gold.vibration_hourly(self.vibration_events))

    @cached_property
    def energy_hourly(self) -> DataFrame:
        return self._table("energy_hourly", lambda: gold.energy_hourly(self.power_events))

    @cached_property
    def energy_daily(self) -> DataFrame:
        return self._table("energy_daily", lambda: gold.energy_daily(self.energy_hourly))


SILVER_TABLES = ["production_events", "vibration_events", "vibration_quarantine", "power_events"]
GOLD_TABLES = ["production_hourly", "vibration_hourly", "energy_hourly", "energy_daily"]
