"""Counting a task's own rows before they are shuffled to keyed state.

A stream has no stateless aggregation, and a state handler that gets one row per event
does its work in Python for each of them. So every task first counts its rows per key
and slot of time, column by column.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .filters import without_nulls
from .windows import micros

#: Combined rows a task holds before it passes them on.
HELD = 1 << 17

# What runs in the tasks travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def slot_start(ts: str | Column, width: str) -> Column:
    """Start of the epoch-aligned slot of ``width`` that a time lies in, in microseconds."""
    at = F.unix_micros(ts)
    return at - F.pmod(at, F.lit(micros(width)))


def _added(parts: list[pa.Table], keys: list[str]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by(keys).aggregate(
        [("n", "sum"), ("first", "min"), ("last", "max")])
    return sums.rename_columns([*keys, "n", "first", "last"])


def slot_counts(rows: DataFrame, keys: Sequence[str], width: str, ts: str = "timestamp") -> DataFrame:
    """Keys, ``slot`` (microseconds), ``n``, ``first`` and ``last`` (timestamps): what each task has seen.

    For batches and streams; a key and slot may have a row from several tasks. Rows with
    a null key or time do not count. ``last`` may carry a watermark: a combined row is
    late when its last event is.
    """
    given = without_nulls(rows, *keys, ts).select(
        *keys, slot_start(ts, width).alias("slot"), F.lit(1).cast("long").alias("n"),
        F.col(ts).alias("first"), F.col(ts).alias("last"))
    names = [*keys, "slot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(_added([pa.Table.from_batches([batch])], names))
            if sum(part.num_rows for part in held) >= HELD:
                yield from _added(held, names).combine_chunks().to_batches()
                held = []
        if held:
            yield from _added(held, names).combine_chunks().to_batches()

    return given.mapInArrow(run, given.schema)
