"""Counts per key, reported for every second of stream time in which they changed."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.windows import tumbling_count

SNAPSHOT_DDL = "key string, tick_ms long, value string"

# The state handler travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PeriodicSnapshot(StatefulProcessor):
    """Adds up pre-counted rows of one key and reports the total at the end of each interval.

    An interval's count arrives once, when it has closed, and a micro-batch may bring
    many of them. Between arrivals the total cannot change and is not reported again.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        held = self.total.get()
        counts = pd.concat([frame[["tick_ms", "count"]] for frame in rows]).sort_values("tick_ms")
        totals = counts["count"].cumsum() + (held[0] if held else 0)
        self.total.update((int(totals.iloc[-1]),))
        yield pd.DataFrame({
            "key": [key[0]] * len(counts), "tick_ms": counts["tick_ms"].to_numpy(),
            "value": totals.astype(str).to_numpy(),
        })

    def close(self) -> None:
        pass


def periodic_snapshot(rows: DataFrame, key: str, every: str = "1 second", ts: str = "timestamp") -> DataFrame:
    """Changes of (key, count as text) per ``every`` of stream time.

    Rows are first counted per key and interval, so the Python state handler
    sees one row per interval instead of one per event.
    """
    counted = tumbling_count(rows, [key], every, ts).select(
        F.col(key).cast("string").alias("key"),
        F.unix_millis("window.end").alias("tick_ms"),
        "count",
    )
    return counted.groupBy("key").transformWithStateInPandas(
        PeriodicSnapshot(),
        outputStructType=SNAPSHOT_DDL,
        outputMode="Append",
        timeMode="None",
    )
