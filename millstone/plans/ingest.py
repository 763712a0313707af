"""Load-path queries (A1, A2, A4, A7): land the raw table, read it back by
case-insensitive column matching, list what was loaded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.plans import profiling as V
from millstone.plans.catalog import Pipeline
from millstone.session import scratch_path
from millstone.sources.bronze import file_manifest


def _land_upper(p: Pipeline) -> str:
    """Write the raw messages with UPPER-CASE column names (as an external
    producer might), one folder per schema version."""
    root = scratch_path(p.spark, f"raw-load/{uuid.uuid4().hex}")
    raw = p.bronze
    raw.select(*[F.col(c).alias(c.upper()) for c in raw.columns]) \
        .write.mode("overwrite").partitionBy("SCHEMA_VERSION").parquet(root)
    return root


def bronze_load(p: Pipeline) -> DataFrame:
    """A1/A2: load all domain prefixes into the Bronze schema and profile."""
    root = _land_upper(p)
    return V.profile_by_version(Pipeline(p.spark, p.sf_dir, bronze_dir=root))


def bronze_file_manifest(p: Pipeline) -> DataFrame:
    """A4: per landed file — path, size, rows (file layout is Spark's
    choice, so there is no SQL oracle: rows-only check)."""
    return file_manifest(p.spark, _land_upper(p))


# the plant's four load prefixes and the versions each one holds
PREFIXES = {
    "production": [S.V_PRODUCTION],
    "vibration_v1": [S.V_VIBRATION_1],
    "vibration_v2": [S.V_VIBRATION_2],
    "power_meter": [S.V_POWER],
}


def bronze_union_domains(p: Pipeline) -> DataFrame:
    """A2: the raw messages land under the plant's four prefixes (one write
    job, one folder per prefix); a single multi-path read loads all four
    into the Bronze schema."""
    root = scratch_path(p.spark, f"raw-prefixes/{uuid.uuid4().hex}")
    v = F.col("schema_version")
    prefix = F.lit(None).cast("string")
    for name, versions in reversed(PREFIXES.items()):
        prefix = F.when(v.isin(*versions), name).otherwise(prefix)
    p.bronze.withColumn("prefix", prefix).write.mode("overwrite").partitionBy("prefix").parquet(root)
    paths = [f"{root}/prefix={name}" for name in PREFIXES]
    return V.profile_by_version(Pipeline(p.spark, p.sf_dir, bronze_dir=paths))
