"""trend_engine: social trend analytics on Spark.

Entry points:

* ``functions``  – column functions (decay score, viral flag, tiers, topics, exact averages, times)
* ``operators``  – latest-per-key, aggregates, top-k, board, views
* ``sources``    – items, messages (Kafka/files), keyed tables and the store, roll-ups, catalog, outputs
* ``streaming``  – the ingest and windowed-topics streams
* ``plans``      – producer stage, reports and payloads, serving reads, registered queries
* ``jobs``       – command-line jobs for each pipeline stage
"""

__version__ = "0.1.0"
