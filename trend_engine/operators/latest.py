"""Latest row per key (keyed last-write-wins).

``groupBy(key).agg(max_by(struct(values), struct(order)))`` is a declarative aggregate with a
partial (map-side) step: each task keeps one candidate per key before the shuffle, so a key
holding a third of all rows ships one row per task, not its whole history. A window with
``row_number`` would instead sort and ship every row of the key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Sequence[str] | None = None) -> DataFrame:
    """Keep, for each ``keys`` value, the row with the greatest ``order`` tuple.

    ``order`` must be unique within a key (add a tie-breaker such as an offset); rows whose
    ordering tuple is entirely null never win over a non-null one.
    """
    keys = list(keys)
    if values is None:
        values = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in values])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, ordering).alias("_latest"))
              .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in values]))
