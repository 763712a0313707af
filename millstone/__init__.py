"""millstone — plant-telemetry analytics on Spark.

Bronze (raw messages) -> Silver (typed, deduplicated, routed) -> Gold
(hourly / daily KPIs) -> business, profiling and alert queries.  Every
transform is a pure ``DataFrame -> DataFrame`` function so batch backfill
and Structured Streaming micro-batches share the same code.
"""

__all__ = ["session", "schema"]
