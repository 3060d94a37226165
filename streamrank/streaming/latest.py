"""Reading stored changes back as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last value per key of changes stored by batch number."""
    others = [c for c in changes.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*others), F.col("batch_id")).alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "newest.*")
