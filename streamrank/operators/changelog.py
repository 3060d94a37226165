"""Tables seen as streams of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .windows import tumbling_count


def count_changelog(
    rows: DataFrame, keys: Sequence[str], width: str, commit: str, ts: str = "timestamp",
    *, null_parts: bool = False,
) -> DataFrame:
    """How windowed counts develop, one change per key, window and commit interval.

    Columns: keys, ``window``, ``committed`` (end of the commit interval) and
    ``old_count`` (null at first) and ``new_count``. ``commit`` must divide
    ``width``, so a window has a fixed number of changes per key.
    """
    steps = tumbling_count(rows, keys, commit, ts, null_parts=null_parts).select(
        *keys,
        F.window("window.start", width).alias("_whole"),
        F.col("window.end").alias("committed"),
        "count",
    )
    so_far = (
        Window.partitionBy(*keys, "_whole").orderBy("committed")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.sum("count").over(so_far)
    return steps.select(
        *keys, F.col("_whole").alias("window"), "committed",
        F.nullif(total - F.col("count"), F.lit(0)).alias("old_count"),
        total.alias("new_count"),
    )
