"""Count per key as text: the last report of the periodic snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.windows import running_count


def state_snapshot(rows: DataFrame, key: str) -> DataFrame:
    counts = running_count(rows, [key])
    return counts.select(
        F.col(key).cast("string").alias("key"), F.col("count").cast("string").alias("value")
    )
