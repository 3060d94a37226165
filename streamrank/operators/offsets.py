"""Positions within topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def next_offsets(records: DataFrame) -> DataFrame:
    """The offset to read next, per topic partition."""
    return records.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    )
