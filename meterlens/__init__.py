"""meterlens — smart-meter telemetry analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so that Catalyst plans it and it scales with the
cluster.  Sub-packages:

* ``sources``   — Kafka-shaped ingest, payload decoding, zone reads, catalog
* ``functions`` — column builders: features, rule predicates, live scoring
* ``operators`` — batch analytics (overview, rules, time series, outliers,
                  alerts, summary/report, live KPIs, rolling baselines)
* ``plans``     — plan helpers (size-checked broadcast joins, skew-safe windows)
* ``streaming`` — Structured Streaming zone writers, pipeline, rollups, state
"""

from meterlens.config import Thresholds, DEFAULT_THRESHOLDS

__all__ = ["Thresholds", "DEFAULT_THRESHOLDS"]
