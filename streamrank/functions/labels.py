"""Readable text for windowed keys and ordered collections."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def window_label(key: Column, start: Column, end: Column) -> Column:
    """``key@startMs->endMs``."""
    return F.concat(
        key.cast("string"), F.lit("@"), F.unix_millis(start).cast("string"),
        F.lit("->"), F.unix_millis(end).cast("string"),
    )


def windowed_key_line(key: Column, start: Column, value: Column) -> Column:
    """``key>startMs=value``."""
    return F.concat(
        key.cast("string"), F.lit(">"), F.unix_millis(start).cast("string"),
        F.lit("="), value.cast("string"),
    )


def lines_of(items: Column) -> Column:
    """Array of text -> each item followed by a newline."""
    return F.array_join(F.transform(items, lambda item: F.concat(item, F.lit("\n"))), "")
