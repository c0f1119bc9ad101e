"""strata: a Spark-native medallion analytics library.

CSV landing files -> bronze (append-only, lineage) -> silver (typed, cleaned,
deduplicated, merged incrementally) -> gold star schema -> KPI tables.
Every transformation is DataFrame -> DataFrame and uses only built-in Spark
expressions, so Catalyst plans the work and it runs on the executors.
"""

__version__ = "0.1.0"
