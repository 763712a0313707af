"""Payload rules on hostile text: the production and power Silver plans over
messages whose payload is rewritten from ``events`` columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstone import schema as S
from millstone.plans import silver
from millstone.plans.catalog import Pipeline

BEYOND_DOUBLE = 9007199254740993    # 2^53 + 1


def _event_number():
    return F.split("correlation_id", "-")[0].cast("long")


def json_typed_extract(p: Pipeline) -> DataFrame:
    """A key name as a value and as a nested key is not a
    top-level key, numbers come as text, integers pass 2^53, fractions round
    and a number key may hold words."""
    n = _event_number()
    text = F.concat(F.lit('{"note":"n3_state_code","inner":{"n3_state_code":1},"machine_status_heartbeat":"'), 800 + n % 4,
                    F.lit('","counter":'), n + F.lit(BEYOND_DOUBLE), F.lit(',"reason_code_60":"none"'),
                    F.lit(',"wo_part_counter_delta_60":'), n % 10, F.lit(".6}"))
    b = p.bronze.filter(F.col("schema_version") == S.V_PRODUCTION).withColumn("payload", text)
    return silver.silver_production(b, p.machine_config).groupBy("asset", "payload_format").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("state_code").alias("state_sum"),
        F.max("counter").alias("max_counter"), F.sum("parts_delta").alias("parts"),
        F.count("reason_code").alias("reasons"))


def json_invalid_routing(p: Pipeline) -> DataFrame:
    """Cut-off text, an array and NULL go to quarantine, the rest to the
    event tables; messages per version and route."""
    n, text = _event_number() % 13, F.col("payload")
    broken = (F.when(n == 0, F.substr(text, F.lit(1), F.length(text) - 1))
              .when(n == 1, F.concat(F.lit("["), text, F.lit("]")))
              .when(n == 2, F.lit(None)).otherwise(text))
    b = p.bronze.filter(F.col("schema_version").isin(S.V_PRODUCTION, S.V_POWER)).withColumn("payload", broken)
    parts = [("events", silver.silver_production(b, p.machine_config)), ("events", silver.silver_power(b)),
             ("quarantine", silver.silver_unparsable(b))]
    rows = [df.select("schema_version", F.lit(route).alias("route")) for route, df in parts]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("schema_version", "route").agg(
        F.count(F.lit(1)).alias("messages"))
