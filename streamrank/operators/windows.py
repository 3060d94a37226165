"""Counts per key over tumbling, hopping and session windows.

Each function takes a batch or a streaming DataFrame and returns the key
columns, ``window`` (``start``/``end`` timestamps) and ``count``. Rows with a
null key do not count; pass ``null_parts=True`` where the columns are parts of
one record that is never null itself. Streams need a watermark set before the
call if they are to be written in append mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .filters import without_nulls


def micros(interval: str) -> int:
    """Length of an interval such as ``"1 hour 30 minutes"`` in microseconds.

    Months and years have no fixed length, for windows of streams as well.
    """
    unit = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
    words = interval.lower().removeprefix("interval ").split()
    pairs = [*zip(words[::2], words[1::2])]
    if not words or len(words) % 2 or any(n.rstrip("s") not in unit for _, n in pairs):
        raise ValueError(f"not an interval of a fixed length: {interval!r}")
    return sum(int(number) * unit[name.rstrip("s")] for number, name in pairs)


def _later(start: str, interval_us: int) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + interval_us)


def _keyed(rows: DataFrame, keys: Sequence[str], null_parts: bool) -> DataFrame:
    return rows if null_parts else without_nulls(rows, *keys)


def _with_window(counts: DataFrame, keys: Sequence[str], width: str) -> DataFrame:
    """Counts by window start, with the window in its place."""
    end = _later("_start", micros(width))
    window = F.struct(F.col("_start").alias("start"), end.alias("end"))
    return counts.select(*keys, window.alias("window"), "count")


def _span(first: str, last: str) -> Column:
    """From the earliest first to the latest last time, as a window."""
    return F.struct(F.min(first).alias("start"), F.max(last).alias("end")).alias("window")


def running_count(
    rows: DataFrame, keys: Sequence[str], *, null_parts: bool = False
) -> DataFrame:
    """Count per key over everything seen so far."""
    return _keyed(rows, keys, null_parts).groupBy(*keys).count()


def tumbling_count(
    rows: DataFrame, keys: Sequence[str], width: str, ts: str = "timestamp",
    *, null_parts: bool = False,
) -> DataFrame:
    """Count per key and epoch-aligned window of the given width.

    Streams group by the whole window, which carries the watermark. In batch
    its start tells as much and makes for smaller rows to shuffle.
    """
    keyed, window = _keyed(rows, keys, null_parts), F.window(ts, width)
    if rows.isStreaming:
        return keyed.groupBy(*keys, window.alias("window")).count()
    counts = keyed.groupBy(*keys, window["start"].alias("_start")).count()
    return _with_window(counts, keys, width)


def hopping_count(
    rows: DataFrame, keys: Sequence[str], width: str, advance: str, ts: str = "timestamp",
    *, null_parts: bool = False, final_only: bool = False,
) -> DataFrame:
    """Count per key and overlapping window of ``width``, one every ``advance``.

    Rows are first counted per ``advance`` slot, and only the slot counts are
    copied into the windows that cover them. A stream can do so only if it is
    ``final_only``, written in append mode; one that reports every change copies
    its rows.
    """
    hops_per_window, uneven = divmod(micros(width), micros(advance))
    if rows.isStreaming and final_only and not uneven:
        slots = tumbling_count(rows, keys, advance, ts, null_parts=null_parts)
        return slots.groupBy(*keys, F.window("window", width, advance).alias("window")).agg(
            F.sum("count").alias("count"))
    if rows.isStreaming or uneven:
        hops = F.window(ts, width, advance).alias("window")
        return _keyed(rows, keys, null_parts).groupBy(*keys, hops).count()
    slots = tumbling_count(rows, keys, advance, ts, null_parts=null_parts)
    starts = F.array(*[_later("window.start", -micros(advance) * i) for i in range(hops_per_window)])
    counts = (
        slots.select(*keys, F.explode(starts).alias("_start"), "count")
        .groupBy(*keys, "_start")
        .agg(F.sum("count").alias("count"))
    )
    return _with_window(counts, keys, width)


def session_count(
    rows: DataFrame, keys: Sequence[str], gap: str, ts: str = "timestamp",
    *, null_parts: bool = False,
) -> DataFrame:
    """Count per key and session: events at most ``gap`` apart belong together.

    ``window.end`` is the time of the last event. Streams use the built-in
    session window, which must be written in append mode.

    In batch, rows are first counted per ``gap``-wide slot. Two events in one
    slot are less than ``gap`` apart, so a slot never spans two sessions. This
    spreads a busy key over many tasks and leaves one row per slot to be put in
    time order, however many events the key has.
    """
    keyed = _keyed(rows, keys, null_parts)
    if rows.isStreaming:
        return (
            keyed.groupBy(*keys, F.session_window(ts, gap).alias("session"))
            .agg(_span(ts, ts), F.count("*").alias("count"))
            .select(*keys, "window", "count")
        )
    gap_us = micros(gap)
    at = F.unix_micros(ts)
    slots = (
        keyed.groupBy(*keys, (at - F.pmod(at, F.lit(gap_us))).alias("_slot"))
        .agg(F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    in_order = Window.partitionBy(*keys).orderBy("_slot")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    idle = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(in_order))
    return (
        slots.withColumn("_opens", F.when(idle <= gap_us, 0).otherwise(1))
        .withColumn("_session", F.sum("_opens").over(so_far))
        .groupBy(*keys, "_session")
        .agg(_span("_first", "_last"), F.sum("_n").alias("count"))
        .drop("_session")
    )
