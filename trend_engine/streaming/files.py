"""Replaying stored observations through the streaming jobs: messages landed as Parquet files with
Kafka's columns (key, value, partition, offset).

A topic partition keeps a key's messages in order; here ``partition`` is a hash of the key and ``offset``
the arrival number the caller gives, so order within a key survives files of any number and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trend_engine.schema import ENVELOPE
from trend_engine.sources.messages import envelope

#: Partitions of the replayed topic.
TOPIC_PARTITIONS = 4


def land_envelopes(posts: DataFrame, path: str, arrival: Column, partitions: int = TOPIC_PARTITIONS) -> None:
    """Append the messages of ``posts``; ``arrival`` numbers them in the order they were sent."""
    rows = envelope(posts.withColumn("offset", arrival.cast("long")), keep=["offset"])
    spread = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(partitions)).cast("int")
    rows.withColumn("partition", spread).select(*ENVELOPE.fieldNames()).write.mode("append").parquet(path)
