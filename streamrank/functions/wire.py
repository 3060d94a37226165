"""Byte forms of keys and values on a topic.

Longs travel as 8 big-endian bytes and a windowed key as the key's UTF-8 bytes
followed by the window start in that form, so consumers that use the stock
long and time-window deserialisers can read what these jobs write.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def long_to_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def bytes_to_long(value: Column) -> Column:
    return F.conv(F.hex(value), 16, -10).cast("long")


def windowed_key_to_bytes(key: Column, start_ms: Column) -> Column:
    return F.concat(F.encode(key, "UTF-8"), long_to_bytes(start_ms))


def bytes_to_windowed_key(value: Column) -> tuple[Column, Column]:
    """(key, window start in epoch ms)."""
    key_bytes = F.length(value) - 8
    key = F.decode(F.substring(value, F.lit(1), key_bytes), "UTF-8")
    return key, bytes_to_long(F.substring(value, key_bytes + 1, F.lit(8)))
